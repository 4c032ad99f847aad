"""Main text of web pages.

Markup sorts the blocks of a page into main text, noise and what it leaves in doubt:
text of pages without an article or main element, text beside the article, and parts
of an article whose class names only hint at noise. The pages of a host decide on the
doubtful ones: their token streams are put end to end, a suffix array finds long
substrings that distinct pages share, and what these cover is boilerplate. A large
host is many tasks: each sorts the suffixes of its pages, and equal heads of suffixes
meet. Text that is surely of the article is never removed for being repeated, since
copies of an article and passages that articles share are main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import map_batches, map_groups, stored

#: Tokens that distinct pages must share in a row to be boilerplate.
RUN = 6
#: Pages that are cleaned together, with the shared heads that they hold.
UNIT = 512

# What elements and their class, id or role names mean.
RAW = frozenset("script style title noscript template textarea iframe svg math object canvas".split())
NOISE = frozenset("nav aside footer form button select dialog menu head label".split())
SECTIONS = frozenset("article main section nav aside header footer form td th body dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar "
    "nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations comments comment respond replies disqus widget toolbar login search "
    "pagination pager skip contentinfo complementary alert dialog".split()
)
#: Names that an article may have for remarks of its own.
REMARKS = frozenset("alert notice notices".split())
#: What the last word of a name is where the name is that of a holder of noise.
HOLDERS = frozenset(
    "area bar block box button buttons container content form group heading icon icons inner item items "
    "link links list panel row section slot title unit wrap wrapper".split()
)
ARTICLE_NOISE = frozenset("comment comments reply ad advert advertisement teaser promo".split())
CONTENT = frozenset(
    "article post story entry article-body article-content post-body post-content entry-content story-body "
    "main-content content maincontent articlebody".split()
)

# Quotes count after an equals sign only; nothing is tried twice.
_TAG = re.compile(
    r"""<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>=]++|=(?>\s*"[^"]*"|\s*'[^']*'|))*+)>)"""
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
#: Class names that say what an element has around or beside it, not what it is.
_MODIFIER = re.compile(r"(?:no|has|with|without)[-_]")
_OPEN_TAG = re.compile(r"<[a-zA-Z/!?]")

#: What a piece of text stands in: the deepest kind of content around it. Noise that
#: only a class name tells may hold an article, which counts where there is no other.
NOWHERE, NOISY, BODY, BURIED, CONTAINER, MAIN, ARTICLE = range(7)
#: What becomes of a block: kept, left to the host, dropped.
SURE, DOUBT, NOISE_BLOCK = range(3)


class Block(NamedTuple):
    kind: int
    text: str
    #: Whether class names hint at noise.
    hinted: bool = False
    #: Number of the outermost article it is in, and characters of it that are links.
    article: int = 0
    linked: int = 0


def _names(attributes: str) -> tuple[list[str], list[list[str]]]:
    """Whole class, id and role names, and the words that each is made of."""
    whole = [v for m in _NAMED.finditer(attributes) for v in (m[2] or m[3] or m[4] or "").lower().split()]
    named = [name for name in whole if not _MODIFIER.match(name)]
    return whole, [[part for part in re.split(r"[^a-z0-9]+", name) if part] for name in named]


def _hint(words: list[str]) -> bool:
    """Whether a name with a word of noise only hints at it, inside an article:
    ``related-work`` does, ``related`` and ``related-links`` tell it."""
    return words[-1] not in NAMES | HOLDERS or words[0] in REMARKS


def _meaning(name: str, attributes: str, around: int, hinted: bool) -> tuple[int, bool]:
    """The kind of content that an element opens, given what is around it, and
    whether its names hint at noise."""
    inside = around in (ARTICLE, BURIED)
    if around == NOWHERE:
        return NOWHERE, hinted
    if name in ("html", "body"):
        return BODY, hinted
    whole, names = _names(attributes) if attributes else ([], [])
    if attributes and _HIDDEN.search(attributes):
        return NOWHERE, hinted
    if name == "article":
        if ARTICLE_NOISE.intersection(whole):
            return NOWHERE, hinted
        return BURIED if around in (NOISY, BURIED) else ARTICLE, hinted
    if name in NOISE or name == "header" and not inside:
        return NOWHERE, hinted
    if around == NOISY:
        return NOISY, hinted
    if name == "main" or "main" in whole and around < MAIN and not inside:
        return max(around, MAIN), hinted
    noise = [words for words in names if NAMES.intersection(words)]
    if noise and inside and all(map(_hint, noise)):
        return around, True
    if noise or not inside and any("header" in words for words in names):
        return NOISY, hinted
    if CONTENT.intersection(whole) and not inside:
        return max(around, CONTAINER), hinted
    return around, hinted


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, noise as such, scripts and the like left out.
    Character references are decoded and white space is one space. Tags that are never
    closed reach to the end of what is around them; a comment, script or tag that is
    cut off takes the rest of the page. Time is linear in the length of the page."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []
    # Places of the open elements by name, and of those that are sections.
    places: dict[str, list[int]] = {}
    sections: list[int] = []
    pending: list[str] = []
    kind, hinted, at, end = BODY, False, 0, len(page)
    article, linked = 0, 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            pending.append(piece)
            if places.get("a"):
                linked += len(piece)

    def close() -> None:
        nonlocal linked
        if pending:
            joined = " ".join(html.unescape("".join(pending)).split())
            pending.clear()
            if joined:
                out.append(Block(kind, joined, hinted, article if kind in (ARTICLE, BURIED) else 0, linked))
        linked = 0

    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            rest = page[at:]
            cut = _OPEN_TAG.search(rest)
            text(rest[: cut.start()] if cut else rest)
            break
        text(page[at : tag.start()])
        at = tag.end()
        if tag[1]:
            stop = page.find("-->", at)
            at = end if stop < 0 else stop + 3
            continue
        if tag[2]:
            stop = page.find(">", at)
            at = end if stop < 0 else stop + 1
            continue
        name, attributes = tag[4].lower(), tag[5]
        if name not in INLINE:
            close()
        if name in RAW and not tag[3]:
            stop = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            # Only foreign elements can close themselves.
            if name not in ("svg", "math") or not attributes.endswith("/"):
                at = stop.end() if stop else end
            continue
        if name in VOID:
            continue
        if not tag[3]:
            inner = _meaning(name, attributes, kind, hinted)
            if inner != (kind, hinted):
                close()
            if name == "article" and kind not in (ARTICLE, BURIED):
                article += 1
            places.setdefault(name, []).append(len(stack))
            if name in SECTIONS:
                sections.append(len(stack))
            stack.append((name, kind, hinted))
            kind, hinted = inner
            continue
        # A closing tag ends the nearest open element of its name, but not one
        # beyond a section that is still open.
        mine = places.get(name)
        if not mine or name not in SECTIONS and sections and sections[-1] > mine[-1]:
            continue
        place = mine[-1]
        if stack[place][1:] != (kind, hinted):
            close()
        kind, hinted = stack[place][1:]
        for gone in stack[place:]:
            places[gone[0]].pop()
        del stack[place:]
        while sections and sections[-1] >= place:
            sections.pop()
    close()
    return out


def sorted_blocks(found: list[Block]) -> list[int]:
    """What markup makes of each block. The text of articles is kept, else that of the
    main element, else of a content container, else of an article inside of noise.
    Left to the host are hinted parts, what a main element has beside its article,
    all but the largest article if they are mostly links, and all text of pages that
    have no such element."""
    best = max((block.kind for block in found), default=NOWHERE)
    sizes: Counter[int] = Counter()
    links: Counter[int] = Counter()
    for block in found:
        if block.kind == best:
            sizes[block.article] += len(block.text)
            links[block.article] += block.linked
    largest = max(sizes, key=lambda n: sizes[n], default=0)

    def role(block: Block) -> int:
        if best <= NOISY or block.kind < best and not (best == ARTICLE and block.kind == MAIN):
            return NOISE_BLOCK
        listing = block.article != largest and 2 * links[block.article] > sizes[block.article]
        return DOUBT if block.kind < best or best == BODY or block.hinted or listing else SURE

    return [role(block) for block in found]


def suffix_heads(streams: list[list[str]], groups: list[int], run: int = RUN) -> tuple[np.ndarray, ...]:
    """The suffix array of the streams put end to end, by the first ``run`` tokens.

    Suffixes are sorted by prefix doubling; those of one group that agree on ``run``
    tokens stand together. Per such set: stream and place of one of its suffixes, and
    the first and last stream that have one. None crosses the end of a stream, nor an
    empty token, which stands for text that takes no part.
    """
    codes: dict[str, int] = {"": 0}
    sizes = np.array([len(tokens) for tokens in streams], dtype=np.int64)
    owner = np.repeat(np.arange(len(streams)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    stream = np.array([codes.setdefault(t, len(codes)) for tokens in streams for t in tokens], dtype=np.int64)
    # Suffixes whose first tokens are all there.
    whole = place + run <= np.repeat(sizes, sizes)
    breaks = np.concatenate([[0], np.cumsum(stream == 0)])
    stops = np.minimum(np.arange(len(stream)) + run, len(stream))
    whole &= breaks[stops] == breaks[: len(stream)]
    group = np.asarray(groups, dtype=np.int64)[owner]
    rank = np.unique(stream + group * len(codes), return_inverse=True)[1]
    done = 1
    while done < run:
        step = min(done, run - done)
        shifted = np.zeros_like(rank)
        shifted[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 2) + shifted, return_inverse=True)[1]
        done += step
    order = np.argsort(rank, kind="stable")
    order = order[whole[order]]
    ranks, owners = rank[order], owner[order]
    if not len(order):
        return (np.zeros(0, dtype=np.int64),) * 4
    first = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
    low, high = np.minimum.reduceat(owners, first), np.maximum.reduceat(owners, first)
    return owners[first], place[order[first]], low, high


def unique_blocks(found: list[str], roles: list[int], shared: Callable[[str], bool], run: int = RUN) -> str:
    """A page without noise and without what ``shared`` heads cover of the doubtful
    blocks. A block loses covered tokens if they are all of it or ``run`` in a row:
    where a shared menu ends, the next block may happen to go on alike for a word."""
    tokens = stream_of(found, roles)
    covered = np.zeros(len(tokens) + 1, dtype=np.int64)
    for at in range(len(tokens) - run + 1):
        if shared(" ".join(tokens[at : at + run])):
            covered[at] += 1
            covered[at + run] -= 1
    cover = np.cumsum(covered)[:-1] > 0
    kept, at = [], 0
    for block, role in zip(found, roles):
        if role == SURE:
            kept.append(block)
            at += 1
            continue
        words = block.split(" ")
        mine = cover[at : at + len(words)]
        at += len(words)
        if role == DOUBT and not mine.all():
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            gone = np.zeros(len(words), dtype=bool)
            for low, high in edges.reshape(-1, 2).tolist():
                gone[low:high] = high - low >= run
            kept += [word for word, g in zip(words, gone.tolist()) if not g]
    return " ".join(kept)


def stream_of(found: list[str], roles: list[int]) -> list[str]:
    """The tokens of a page that its host looks at; an empty one for each block that
    is surely main text."""
    return [token for block, role in zip(found, roles) for token in ([""] if role == SURE else block.split(" "))]


def extract_main(pages: DataFrame, run: int = RUN) -> DataFrame:
    """(page_id, url, text, n_chars), one row per input row.

    Text that markup settles never leaves its task. All other blocks of all pages of a
    host go through its suffix array, which decides on the doubtful ones; the result
    does not depend on how many pages a host has beyond that. A null or empty html has
    empty text; pages without a host share one; a page alone on its host keeps its
    doubtful blocks; repeated rows are distinct pages. Other columns are not read, an
    empty table gives no rows.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    link = pages.schema["url"].dataType.simpleString()

    def parse(batch: pa.RecordBatch):
        texts, streams, roles = [], [], []
        for page in batch.column("html").to_pylist():
            found = blocks(page or "")
            role = sorted_blocks(found)
            if DOUBT in role:
                texts.append(None)
            else:
                texts.append(" ".join(b.text for b, r in zip(found, role) if r == SURE))
                # Only where the main text stands matters to the host.
                some = [n for n, r in enumerate(role) if r != SURE or n and role[n - 1] != SURE]
                found = [found[n] if role[n] != SURE else found[n]._replace(text="") for n in some]
                role = [role[n] for n in some]
            streams.append([b.text for b in found])
            roles.append(role)
        columns = [
            *(batch.column(name) for name in ("page", "page_id", "url", "host")),
            pa.array(texts, pa.string()), pa.array(streams, pa.list_(pa.string())), pa.array(roles, pa.list_(pa.int8())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["page", "page_id", "url", "host", "text", "blocks", "roles"])

    host = F.coalesce(F.lower(F.try_parse_url(F.col("url"), F.lit("HOST"))), F.lit(""))
    numbered = pages.select(F.monotonically_increasing_id().alias("page"), "page_id", "url", host.alias("host"), "html")
    schema = f"page long, page_id {kind}, url {link}, host string, text string, blocks array<string>, roles array<byte>"
    parsed = stored(map_batches(numbered, parse, schema), "pages")

    def heads(batch: pa.RecordBatch):
        page, hosts = batch.column("page").to_numpy(), batch.column("host").to_pylist()
        streams = list(map(stream_of, batch.column("blocks").to_pylist(), batch.column("roles").to_pylist()))
        open_ = batch.column("open").to_pylist()
        names: dict[tuple, int] = {}
        # Settled and open pages apart, since only heads of the latter are asked for.
        groups = [names.setdefault((p // UNIT, h, o), len(names)) for p, h, o in zip(page.tolist(), hosts, open_)]
        of, at, low, high = suffix_heads(streams, groups, run)
        texts = [" ".join(streams[n][a : a + run]) for n, a in zip(of.tolist(), at.tolist())]
        columns = [
            pa.array(page[of] // UNIT), pa.array([hosts[n] for n in of.tolist()], pa.string()), pa.array(texts, pa.string()),
            pa.array(page[low]), pa.array(page[high]), pa.array([open_[n] for n in of.tolist()], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["unit", "host", "head", "low", "high", "open"])

    sought = parsed.select("page", "host", "blocks", "roles", F.col("text").isNull().alias("open"))
    schema = "unit long, host string, head string, low long, high long, open boolean"
    found = stored(map_batches(sought, heads, schema), "page-heads")
    # A head that very many pages have is a row per unit at most, and one per task here.
    shared = found.groupBy("host", "head").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    shared = shared.filter("low < high").select("host", "head")
    asked = found.filter("open").select("unit", "host", "head").distinct().join(shared, ["host", "head"])
    doubtful = parsed.filter(F.col("text").isNull()).withColumn("unit", F.floor(F.col("page") / UNIT))
    doubtful = doubtful.select("unit", "host", F.lit(None).cast("string").alias("head"), "page_id", "url", "blocks", "roles")
    asked = asked.select("unit", "host", "head", *(F.lit(None).cast(t.dataType).alias(t.name) for t in doubtful.schema.fields[3:]))

    def clean(rows: pa.Table, bounds: np.ndarray):
        unit = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).tolist()
        hosts, names = rows.column("host").to_pylist(), rows.column("head").to_pylist()
        known = {(u, h, n) for u, h, n in zip(unit, hosts, names) if n is not None}
        own = [i for i, n in enumerate(names) if n is None]
        found, roles = rows.column("blocks").to_pylist(), rows.column("roles").to_pylist()
        texts = [unique_blocks(found[i], roles[i], lambda head: (unit[i], hosts[i], head) in known, run) for i in own]
        some = rows.select(["page_id", "url"]).take(pa.array(own, pa.int64())).combine_chunks()
        columns = [some.column(0).combine_chunks(), some.column(1).combine_chunks(), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    cleaned = map_groups(doubtful.unionByName(asked), ["unit"], clean, f"page_id {kind}, url {link}, text string")
    settled = parsed.filter(F.col("text").isNotNull()).select("page_id", "url", "text")
    rows = settled.unionByName(cleaned)
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
