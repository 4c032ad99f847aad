"""DataFrame to DataFrame operators; none of them reads, writes or runs a job."""
