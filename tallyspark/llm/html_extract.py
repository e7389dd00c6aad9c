"""Main text of web pages with a host-wide suffix array (operator 5).

1. Each page's markup is cut into text blocks (block-level elements and line breaks end a
   block), each with its zone: *chrome* (menus, headers, footers, asides, adverts, forms,
   notices, comments, by element name or by class/id/role words), *article* (inside
   ``article`` or ``main``) or *open* (neither).  Scripts, styles, comments of the markup and the like give
   no text.  Character references are decoded, white space inside a block becomes one space.
2. A host of up to ``GROUP_CHARS`` characters is one task: its blocks are concatenated as
   one word stream with a unique separator after each block; prefix doubling sorts its
   suffixes by their first ``RUN`` words, and equal runs on distinct pages are the
   repeated substrings; overlapping runs join to long ones.  On a larger host the runs, as
   64-bit hashes, are dealt by hash to buckets instead, each a task that finds the runs of
   several pages and sums what a page shares with which earlier page; copies, templates and
   site notices are then counted over the whole host by joins of these sums and of the runs
   that can decide about text, and those that count go back to the pages.  Both ways give the
   same texts.
3. Words that such runs cover are boilerplate candidates.  Pages that share most of their
   article, or without article most of their open text, (copies) count as one page, so copies
   do not make each other's text boilerplate.  Open runs of more than half of the host's
   pages (four at least) are a template and do not make copies, unless they are nearly all of
   a page; pages of equal open text are one page before any of this is counted.
   On a page without article the open blocks are its text, less those covered by more than
   half.  An article block goes if every word is covered by runs that stand in chrome on
   more than half of the host's pages (four at least): a notice of the whole site.  Passages
   that articles share, or that a few pages also show as advert, stay.  Chrome is never kept.

Results for odd input: null html gives the empty text; unclosed and truncated markup is read
as far as it goes (a half tag at the end is dropped, a half character reference stays as
text); pages without host form a group of their own; repeated rows get equal results; an
empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import is_broadcastable, write_table
from tallyspark.llm.components import connected_components
from tallyspark.llm.wordio import mix, text_slices, word_hashes

RUN = 8                    # words of the shortest repeated substring that counts
SITE_PAGES = 4             # least pages that show a run as chrome before it counts as the site's
GROUP_CHARS = 2_000_000    # characters of html of the largest host that is one task
BUCKET_GROUPS = 10         # a bucket of a larger host has the runs of so many times these characters, about
SLICE_BYTES = 2_000_000    # of html cut into runs at a time

# Fixed values of HTML: elements by what they mean for the text.
_NO_TEXT = frozenset("script style noscript template svg math iframe object canvas audio video head title textarea select option button datalist".split())
_CHROME = frozenset("nav header footer aside form menu dialog fieldset".split())
_ARTICLE = frozenset("article main".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Text elements that cannot hold their like: without an end tag of their own they end at the next block.
_UNNESTED = frozenset("option button".split())
_NEXT_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCK))})(?=[\s/>])", re.I)
#: An element that opens closes an open one of the same set (omitted end tags).
_SELF_CLOSING = {"p": "p", "li": "li", "td": "td", "th": "th", "tr": "tr", "dt": "dt", "dd": "dd", "option": "option"}
#: Words in class, id, role or aria-label that mark chrome.
_CHROME_WORDS = re.compile(
    r"(?<![a-z])(?<!no[-_])(?<!has[-_])(?<!with[-_])(?<!without[-_])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|sidebar|side-bar|nav\w*|menu\w*|breadcrumbs?|footer|masthead|"
    r"cookies?|consent|gdpr|notice|newsletter|subscribe|signup|sign-up|login|popup|pop-up|modal|overlay|social|share|sharing|"
    r"related|recommend\w*|comments?|respond|replies|widget|toolbar|pagination|pager|contentinfo|complementary|navigation|"
    r"search|skip-link|copyright|legal|disclaimer|alert)(?![a-z])")
#: Words that name a container, not what it holds.
_FRAME_WORDS = re.compile(r"(?<![a-z])(?:slot|box|container|wrap|wrapper|block|bar|buttons?|list|links?|unit|area|panel|posts?|articles|"
                          r"stories|thread|form|row|inner|outer|top|bottom|left|right)(?![a-z])")
#: A quote opens a value only directly after an equals sign; elsewhere it is a character like others.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)", re.S)
_MARKS = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
OPEN, ARTICLE, CHROME = 0, 1, 2


def _marks_chrome(marks: str, in_article: bool) -> bool:
    """Whether class, id, role or label words mark chrome: any marker word outside an article;
    inside one two different ones, or a name of marker and container words only (``share-bar``,
    not ``share-price``)."""
    found = set(_CHROME_WORDS.findall(marks))
    if not found or not in_article:
        return bool(found)
    return len(found) > 1 or any(_CHROME_WORDS.search(name) and not re.search("[a-z]", _FRAME_WORDS.sub("", _CHROME_WORDS.sub("", name)))
                                 for name in marks.split())


def page_blocks(source: str | None) -> list[tuple[int, str]]:
    """The text blocks of a page in order: (zone, text), white space collapsed, none empty."""
    source = source or ""
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []   # open elements and the zone around them
    zone, parts, at, end = OPEN, [], 0, len(source)

    def flush() -> None:
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            parts.clear()
            if text:
                blocks.append((zone, text))

    def close(depth: int) -> None:
        nonlocal zone
        if any(name in _BLOCK for name, _ in stack[depth:]):
            flush()
        zone = stack[depth][1]
        del stack[depth:]

    while at < end:
        m = _TOKEN.search(source, at)
        if m is None:
            parts.append(source[at:])
            break
        parts.append(source[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if depth >= 0:
                close(depth)
            elif name in _BLOCK:
                flush()
            continue
        if name in _NO_TEXT:  # raw content: up to its end tag
            if not m[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\s*>" + (rf"|<{name}(?=[\s/>])" if name in _UNNESTED else ""), re.I).search(source, at)
                if name in _UNNESTED and not (stop and stop[0].startswith("</")):
                    block = _NEXT_BLOCK.search(source, at)
                    at = block.start() if block else end
                elif stop:
                    at = stop.end()
                elif name != "head":
                    at = end
            continue
        if name in _BLOCK:
            flush()
        if name in _VOID or m[3].rstrip().endswith("/"):
            continue
        if name in _SELF_CLOSING:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if stack[i][0] in _CHROME or stack[i][0] in _ARTICLE or stack[i][0] in ("div", "ul", "ol", "table", "section"):
                    break
        stack.append((name, zone))
        marks = " ".join(a or b or c for a, b, c in _MARKS.findall(m[3])).lower() if "=" in m[3] else ""
        if zone != CHROME:
            in_article = zone == ARTICLE or name in _ARTICLE
            if name in _ARTICLE or name in ("body", "html"):
                zone = ARTICLE if name in _ARTICLE else zone
            elif name in _CHROME and not (name == "header" and in_article):
                zone = CHROME
            elif (marks and _marks_chrome(marks, in_article)) or (m[3] and _HIDDEN.search(m[3])):
                zone = CHROME
    flush()
    return blocks


def run_ranks(stream: np.ndarray, length: int = RUN) -> np.ndarray:
    """Rank of every suffix by its first ``length`` values (a power of two): equal ranks,
    equal substrings.  Prefix doubling; past the end counts as smallest."""
    ranks = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    span = 1
    while span < length:
        follow = np.zeros(len(ranks), dtype=np.int64)
        follow[:-span] = ranks[span:] + 1
        ranks = np.unique(ranks * (len(ranks) + 1) + follow, return_inverse=True)[1].astype(np.int64)
        span *= 2
    return ranks


def covered(starts: np.ndarray, length: int = RUN) -> np.ndarray:
    """Positions within ``length`` values after a marked start."""
    steps = np.zeros(len(starts) + length, dtype=np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + length, -1)
    return np.cumsum(steps[:len(starts)]) > 0


def _copies(page_of: np.ndarray, ranks: np.ndarray, at: np.ndarray, pages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the runs at ``at``: (pages' runs, later page, earlier page, runs of the later one that first stand on the earlier)."""
    order = at[np.lexsort((page_of[at], ranks[at]))]
    new = np.diff(ranks[order], prepend=-1) != 0
    first_page = page_of[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    earlier = first_page < page_of[order]
    pairs, n = np.unique(page_of[order][earlier] * pages + first_page[earlier], return_counts=True)
    return np.bincount(page_of[at], minlength=pages), *np.divmod(pairs, pages), n


def _page_classes(page_of: np.ndarray, zone_of: np.ndarray, ranks: np.ndarray, inside: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Number each page by its class: a page most of whose article runs (without article: open
    runs) stand in an earlier page's joins that page's class (copies); ``same`` has the first
    page of equal text for each."""
    pages = len(same)
    owner = same.copy()
    articled = np.zeros(pages, bool)
    articled[page_of[zone_of == ARTICLE]] = True
    content = inside & (zone_of == np.where(articled[page_of], ARTICLE, OPEN))
    at = np.flatnonzero(content)
    if not len(at):
        return owner
    # open runs that most pages show are a template: as furniture, counted on pages of unlike text
    seen = np.unique(ranks[at] * pages + same[page_of[at]]) // pages
    shown = np.bincount(seen, minlength=int(ranks[at].max()) + 1)[ranks[at]]
    template = ~articled[page_of[at]] & (shown >= SITE_PAGES) & (2 * shown > len(np.unique(same)))
    links = []
    for part, times, of in ((at[~template], 2, 1), (at, 8, 7)):
        runs, later, first, n = _copies(page_of, ranks, part, pages)
        linked = (times * n > of * runs[later]) & ((of == 1) | ~articled[later])
        links.append(np.stack([later[linked], first[linked]], axis=1))
    for page, other in sorted(map(tuple, np.concatenate(links).tolist())):  # ascending pages: owners are settled
        if owner[page] == page:
            owner[page] = owner[other]
    return owner[same]


def extract_group(blocks_of: list[list[tuple[int, str]]], run: int = RUN) -> list[str]:
    """The main texts of the pages of one host group."""
    words, zones, pages, owners, spans = [], [], [], [], []
    for page, blocks in enumerate(blocks_of):
        for number, (zone, text) in enumerate(blocks):
            found = text.split()
            spans.append((page, number, zone, len(words), len(words) + len(found)))
            words.extend(found)
            words.append(None)
    if not spans:
        return ["" for _ in blocks_of]
    for page, number, zone, a, b in spans:
        zones.append(np.full(b - a + 1, zone))
        pages.append(np.full(b - a + 1, page))
        owners.append(np.arange(b - a + 1, 0, -1))  # values left in the block, separator included
    zone_of, page_of, left = np.concatenate(zones), np.concatenate(pages), np.concatenate(owners)
    coded = pa.array(words, pa.string()).dictionary_encode()
    gaps = np.asarray(coded.is_null())
    stream = coded.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    stream[gaps] = len(coded.dictionary) + np.arange(int(gaps.sum()))  # separators never match
    ranks = run_ranks(stream, run)
    inside = left > run
    first_of: dict[tuple, int] = {}
    same = np.array([first_of.setdefault(tuple(b for b in blocks if b[0] != CHROME) or (page,), page)
                     for page, blocks in enumerate(blocks_of)])
    classes = _page_classes(page_of, zone_of, ranks, inside, same)[page_of]
    at = np.flatnonzero(inside)
    order = at[np.lexsort((classes[at], ranks[at]))]
    same_run = np.diff(ranks[order], prepend=-1) == 0
    low = np.flatnonzero(~same_run)
    size = np.diff(np.append(low, len(order)))
    first, last = classes[order][low], classes[order][low + size - 1] if len(low) else low
    many = np.repeat(first != last, size)                        # on pages of several classes
    # pages (classes) on which each run stands in chrome
    chrome = (zone_of[order] == CHROME).astype(np.int64)
    run_of = np.cumsum(~same_run) - 1
    seen = np.unique(run_of[chrome > 0] * len(blocks_of) + classes[order][chrome > 0]) // len(blocks_of)
    in_chrome = np.bincount(seen, minlength=len(low))
    everywhere = (in_chrome >= SITE_PAGES) & (2 * in_chrome > len(np.unique(classes)))
    repeated, furniture = np.zeros(len(stream), bool), np.zeros(len(stream), bool)
    repeated[order], furniture[order] = many, np.repeat(everywhere, size)
    is_repeated, is_furniture = np.cumsum(np.append(0, covered(repeated, run))), np.cumsum(np.append(0, covered(furniture, run)))
    has_article = np.zeros(len(blocks_of), bool)
    has_article[[p for p, _, z, _, _ in spans if z == ARTICLE]] = True
    kept: list[list[str]] = [[] for _ in blocks_of]
    for page, number, zone, a, b in spans:
        if zone == ARTICLE:
            keep = is_furniture[b] - is_furniture[a] < b - a
        else:
            keep = zone == OPEN and not has_article[page] and 2 * (is_repeated[b] - is_repeated[a]) <= b - a
        if keep:
            kept[page].append(blocks_of[page][number][1])
    return ["\n".join(k) for k in kept]


def _extract(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["page_id", "tie"], na_position="last", kind="stable")
    texts = extract_group([page_blocks(h) for h in group["html"]])
    return pd.DataFrame({"page_id": group["page_id"].to_numpy(), "url": group["url"].to_numpy(), "text": texts,
                         "n_chars": np.array([len(t) for t in texts], dtype=np.int64)})


# ---- hosts of more than a task: runs as hashes, counted over the host by joins ----------
#: A page's runs of a kind in a bucket, with the page's place and the digest of its text outside chrome.
_SEGMENT = np.dtype([("tie", "<i8"), ("no_id", "u1"), ("page_id", "<i8"), ("digest", "S16"), ("kind", "u1"), ("n", "<u4")])
#: Kinds: text of an article, chrome, open text beside an article, open text of a page without one.
IN_ARTICLE, IN_CHROME, BESIDE, ALONE = range(4)
_IS_CONTENT = np.array([True, False, False, True])   # what may be kept
_LOW = np.uint64((1 << 48) - 1)
_RUNS_SCHEMA = "host string, bucket long, tie long, page_id long, articled boolean, n long, digest binary, segments binary, runs binary"
_FOUND_SCHEMA = ("host string, tie long, page_id long, articled boolean, n long, digest binary, run long, chrome boolean, "
                 "first long, first_article long, shown long")


def _stream(pages: list[list[tuple[int, str]]], run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The word stream of pages' blocks: hash of the run at each word, whether a run starts
    there, and per block its page and first word (in order of blocks, one more at the end)."""
    words = [text.split() for blocks in pages for _, text in blocks]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    coded = pa.array([w for found in words for w in found], pa.string()).dictionary_encode()
    hashes = word_hashes(coded.dictionary.to_numpy(zero_copy_only=False))[coded.indices.to_numpy(zero_copy_only=False)]
    with np.errstate(over="ignore"):
        value = hashes.copy()
        for j in range(1, min(run, len(hashes))):
            value[:len(hashes) - j] = value[:len(hashes) - j] * np.uint64(0x9FB21C651E98DF25) + mix(hashes[j:] + np.uint64(j))
        value = mix(value)
    first = np.concatenate([[0], np.cumsum(sizes)])
    left = np.repeat(first[1:], sizes) - np.arange(len(value))
    return value, left >= run, np.repeat(np.arange(len(pages)), [len(b) for b in pages]), first


def _run_numbers(value: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 48 bits) of run hashes: the bucket comes from the other 16."""
    return ((value >> np.uint64(48)).astype(np.int64) * buckets) >> 16, (value & _LOW).astype(np.int64)


def _page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pages (tie, page_id, whether it has an article, content runs, digest of the text
    outside chrome) and, per slice, host and bucket, their runs: 48 bits each, by page and kind."""
    names = [c.split()[0] for c in _RUNS_SCHEMA.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 3, pa.bool_(), pa.int64(), *[pa.binary()] * 3]
    for batch in batches:
        for start, stop in text_slices(batch.column("html"), SLICE_BYTES):
            part = batch.slice(start, stop - start)
            blocks_of = [page_blocks(h) for h in part.column("html").to_pylist()]
            hosts, ties, ids = (part.column(c).to_pylist() for c in ("host", "tie", "page_id"))
            tie, page_id = np.array(ties, dtype=np.int64), np.array([i or 0 for i in ids], dtype=np.int64)
            buckets = np.array(part.column("buckets").to_pylist(), dtype=np.int64)
            articled = np.array([any(z == ARTICLE for z, _ in b) for b in blocks_of], dtype=bool)
            value, starts, page_of, first = _stream(blocks_of)
            sizes = np.diff(first)
            zone = np.array([z for b in blocks_of for z, _ in b], dtype=np.int64)
            kind = np.where(zone == CHROME, IN_CHROME, np.where(zone == ARTICLE, IN_ARTICLE, np.where(articled[page_of], BESIDE, ALONE)))
            page, kind, value = np.repeat(page_of, sizes)[starts], np.repeat(kind, sizes)[starts], value[starts]
            content = np.bincount(page[_IS_CONTENT[kind]], minlength=len(ties))
            digests = [xxhash.xxh128_digest("\n".join(f"{z}{t}" for z, t in b if z != CHROME)) if any(z != CHROME for z, _ in b) else None
                       for b in blocks_of]
            rows = [(h, t % n, t, i, a, c, d, None, None)
                    for h, t, i, a, c, d, n in zip(hosts, ties, ids, articled.tolist(), content.tolist(), digests, buckets.tolist())]
            bucket, low = _run_numbers(value, buckets[page])
            coded = part.column("host").dictionary_encode()
            host = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[page]
            group = host * (int(buckets.max()) + 1) + bucket
            inner = page * 4 + kind
            order = np.argsort(group * (4 * len(ties)) + inner, kind="stable")
            group, inner = group[order], inner[order]
            raw = np.ascontiguousarray(low[order]).view(np.uint8).reshape(-1, 8)[:, :6]
            at = np.flatnonzero((np.diff(group, prepend=-1) != 0) | (np.diff(inner, prepend=-1) != 0))
            segments = np.empty(len(at), dtype=_SEGMENT)
            of, segments["kind"], segments["n"] = inner[at] // 4, inner[at] % 4, np.diff(np.append(at, len(group)))
            segments["tie"], segments["page_id"], segments["no_id"] = tie[of], page_id[of], np.array([i is None for i in ids])[of]
            segments["digest"] = np.array([d or b"" for d in digests], dtype="S16")[of]
            new = np.flatnonzero(np.diff(group[at], prepend=-1) != 0)
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(at)]):
                low_at, high_at = int(at[a]), int(at[b]) if b < len(at) else len(group)
                number = int(group[low_at])
                rows.append((coded.dictionary[number // (int(buckets.max()) + 1)].as_py(), number % (int(buckets.max()) + 1),
                             None, None, None, None, None, segments[a:b].tobytes(), raw[low_at:high_at].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _shared_runs(g: pa.Table) -> pa.Table:
    """The pages of a bucket as they are; the runs that stand on several pages, on one of them as
    content and on one in chrome or on a page without article: a row for each page, ``n`` times
    as content and whether in chrome; and what pages' content shares with earlier pages."""
    host, bucket = g["host"][0].as_py(), g["bucket"][0].as_py()
    of_page = pc.is_null(g["segments"])
    longs = [(c, pa.int64()) for c in ("first", "first_article", "shown")]
    schema = pa.schema([("host", pa.string()), ("tie", pa.int64()), ("page_id", pa.int64()), ("articled", pa.bool_()), ("n", pa.int64()),
                        ("digest", pa.binary()), ("run", pa.int64()), ("chrome", pa.bool_()), *longs])

    def table(n: int, columns: dict) -> pa.Table:
        return pa.table([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    mine = g.filter(of_page)
    pages = table(mine.num_rows, {c: mine[c] for c in schema.names[:6]})
    g = g.filter(pc.invert(of_page))
    segments = np.frombuffer(b"".join(g["segments"].to_pylist()), dtype=_SEGMENT)
    raw = np.frombuffer(b"".join(g["runs"].to_pylist()), dtype=np.uint8).reshape(-1, 6)
    low = np.zeros((len(raw), 8), dtype=np.uint8)
    low[:, :6] = raw
    low = low.view(np.int64).reshape(-1)
    if not len(low):
        return pages
    # repeated rows: each page's runs of a kind once
    ties, page = np.unique(segments["tie"], return_inverse=True)
    once = np.zeros(len(segments), dtype=bool)
    once[np.unique(page * 4 + segments["kind"], return_index=True)[1]] = True
    owner = np.repeat(np.arange(len(segments)), segments["n"])
    order = np.argsort(low, kind="stable")
    order = order[once[owner[order]]]
    new = np.diff(low[order], prepend=-1) != 0
    several = np.diff(np.append(np.flatnonzero(new), len(order))) > 1
    order = order[np.repeat(several, np.diff(np.append(np.flatnonzero(new), len(order))))]
    if not len(order):
        return pages
    order = order[np.lexsort((page[owner[order]], low[order]))]
    run, at, kind = low[order], page[owner[order]], segments["kind"][owner[order]]
    new_run = np.diff(run, prepend=-1) != 0
    first = np.flatnonzero(new_run | (np.diff(at, prepend=-1) != 0))     # of each run and page
    n = np.add.reduceat(_IS_CONTENT[kind].astype(np.int64), first)
    chrome = np.add.reduceat((kind == IN_CHROME).astype(np.int64), first) > 0
    run_at = np.flatnonzero(new_run[first])
    pages_of = np.diff(np.append(run_at, len(first)))
    wanted = np.repeat(np.add.reduceat(((kind == IN_CHROME) | (kind == ALONE)).astype(np.int64), first[run_at]) > 0, pages_of)
    keep = wanted & np.repeat((pages_of > 1) & (np.add.reduceat(n, run_at) > 0), pages_of)
    of = first[keep]
    runs = table(len(of), {"host": pa.array([host] * len(of), pa.string()), "tie": pa.array(ties[at[of]], pa.int64()),
                           "n": pa.array(n[keep], pa.int64()), "run": pa.array((bucket << 48) | run[of], pa.int64()),
                           "chrome": pa.array(chrome[keep], pa.bool_())})
    earlier = _earlier_pages(segments[once], page[once], run[first], at[first], n)
    earlier = table(len(earlier), {"host": pa.array([host] * len(earlier), pa.string()), "articled": pa.array(earlier["articled"]),
                                   **{c: pa.array(ties[earlier[c]], pa.int64()) for c in ("tie", "first")},
                                   "first_article": pa.array(ties[earlier["first_article"]], pa.int64(), mask=earlier["first_article"].to_numpy() < 0),
                                   **{c: pa.array(earlier[c], pa.int64()) for c in ("n", "shown")}})
    return pa.concat_tables([pages, runs, earlier])


def _earlier_pages(segments: np.ndarray, page: np.ndarray, run: np.ndarray, at: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    """For the content runs that pages of distinct text share, counted together for each page
    (``tie``): first page and first page with an article (-1: none) that have them, how many
    pages show them, and ``n``, how often they stand on the page.  Pages are numbers.

    ``segments`` are those of the numbers ``page``; run ``run`` stands ``n`` times as content on
    page ``at`` (ascending runs).  Pages of equal text have the same runs, so a bucket sees all
    of them: the first speaks for the others.
    """
    pages = int(page.max()) + 1
    of = np.zeros(pages, dtype=np.int64)
    of[page] = np.arange(len(segments))
    content = np.flatnonzero(_IS_CONTENT[segments["kind"]])
    of[page[content]] = content
    mine = segments[of]
    in_order = np.lexsort((mine["tie"], mine["page_id"], mine["no_id"]))
    rank = np.empty(pages, dtype=np.int64)
    rank[in_order] = np.arange(pages)
    speaks = np.zeros(pages, dtype=bool)
    speaks[in_order[np.unique(mine["digest"][in_order], return_index=True)[1]]] = True
    articled = mine["kind"] == IN_ARTICLE
    entry = np.flatnonzero((n > 0) & speaks[at])
    start = np.flatnonzero(np.diff(run[entry], prepend=-1) != 0)
    size = np.diff(np.append(start, len(entry)))
    several = np.repeat(size > 1, size)
    entry, size = entry[several], size[size > 1]
    start = np.cumsum(size) - size
    place = rank[at[entry]]
    first = np.minimum.reduceat(place, start) if len(start) else start
    first_article = np.minimum.reduceat(np.where(articled[at[entry]], place, pages), start) if len(start) else start
    rows = pd.DataFrame({"tie": at[entry], "first": np.repeat(in_order[first], size),
                         "first_article": np.repeat(np.append(in_order, -1)[first_article], size), "shown": np.repeat(size, size), "n": n[entry]})
    rows = rows.groupby(["tie", "first", "first_article", "shown"], as_index=False, sort=False)["n"].sum()
    return rows.assign(articled=articled[rows["tie"].to_numpy(np.int64)])


def _class_links(pages: DataFrame, earlier: DataFrame, totals: DataFrame) -> DataFrame:
    """(a, b): pages of distinct text and the earlier page that most of their content runs first
    stand on.  Open runs that most pages show are a template, which counts only where nearly
    all of a page stands on the earlier one."""
    rows = (earlier.join(F.broadcast(totals), "host")
            .withColumn("template", (F.col("shown") >= SITE_PAGES) & (2 * F.col("shown") > F.col("texts")))
            .withColumn("skipped", F.col("template") & ~F.col("articled"))
            .withColumn("other", F.when(F.col("template"), F.col("first_article")).otherwise(F.col("first"))))
    own = pages.where("tie = same").select("tie", F.col("n").alias("runs"))
    skipped = rows.where("skipped").groupBy("tie").agg(F.sum("n").alias("of_template"))
    most = (rows.where("NOT skipped AND other <> tie").groupBy("tie", "other").agg(F.sum("n").alias("n"))
            .join(own, "tie").join(skipped, "tie", "left").where(2 * F.col("n") > F.col("runs") - F.coalesce("of_template", F.lit(0))))
    nearly = (rows.where("NOT articled AND first <> tie").groupBy("tie", F.col("first").alias("other")).agg(F.sum("n").alias("n"))
              .join(own, "tie").where("8 * n > 7 * runs"))
    place = pages.select(F.col("tie").alias("other"), F.struct(F.col("page_id").isNull().alias("last"), "page_id", "tie").alias("place"))
    return (most.select("tie", "other").union(nearly.select("tie", "other")).join(place, "other")
            .groupBy("tie").agg(F.min("place").alias("place")).select(F.col("tie").alias("a"), F.col("place.tie").alias("b")))


def _large_hosts(rows: DataFrame) -> DataFrame:
    """``extract_pages`` of rows with their host's number of buckets."""
    found = write_table(rows.select("host", "buckets", "tie", "page_id", "html").mapInArrow(_page_runs, _RUNS_SCHEMA)
                        .groupBy("host", "bucket").applyInArrow(_shared_runs, _FOUND_SCHEMA), "runs")
    wanted = found.where("run IS NOT NULL").select("host", "run", "tie", "n", "chrome")
    earlier = found.where("first IS NOT NULL").select("host", "tie", "articled", "first", "first_article", "shown", "n")
    pages = (found.where("run IS NULL AND first IS NULL").groupBy("host", "tie")
             .agg(*(F.first(c).alias(c) for c in ("page_id", "articled", "n", "digest")), F.count("*").alias("rows")))
    # pages of equal text outside chrome are one text; a page with none is a text for each of its rows
    place = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "tie")
    texts = pages.where("digest IS NOT NULL").groupBy("host", "digest").agg(F.min(place).alias("first"))
    pages = write_table(pages.join(texts, ["host", "digest"], "left").select(
        "host", "tie", "page_id", "articled", "n", F.coalesce("first.tie", "tie").alias("same"),
        F.when(F.col("digest").isNull(), F.col("rows")).otherwise(1).alias("weight")), "pages")
    totals = pages.where("tie = same").groupBy("host").agg(F.sum("weight").alias("texts"))
    links = write_table(_class_links(pages, earlier, totals), "copies")
    classes = pages.select("host", "tie", "articled", F.col("same").alias("class"), "weight")
    if not links.isEmpty():
        labels = connected_components(links)
        classes = (classes.join(labels, F.col("class") == F.col("id"), "left")
                   .select("host", "tie", "articled", F.coalesce("component", "class").alias("class"), "weight"))
    classes = write_table(classes, "classes")
    counts = classes.select("host", "class", "weight").distinct().groupBy("host").agg(F.sum("weight").alias("classes"))
    marks = (wanted.join(classes.select("tie", "class", "weight"), "tie").groupBy("host", "run", "class", "weight")
             .agg(F.max("chrome").alias("chrome")).groupBy("host", "run")
             .agg(F.sum("weight").alias("shown"), F.sum(F.when(F.col("chrome"), F.col("weight")).otherwise(0)).alias("in_chrome")))
    marks = write_table(marks.join(F.broadcast(counts), "host").select(
        "host", "run", (F.col("shown") > 1).alias("repeated"),
        ((F.col("in_chrome") >= SITE_PAGES) & (2 * F.col("in_chrome") > F.col("classes"))).alias("furniture")), "marks")
    # a host's site runs: at most twice what chrome of a page holds
    furniture = marks.where("furniture").groupBy(F.col("host").alias("h")).agg(F.collect_list("run").alias("furniture"))
    repeated = write_table(wanted.where("n > 0").join(classes.where("NOT articled").select("tie"), "tie")
                           .join(marks.where("repeated").select("host", "run"), ["host", "run"])
                           .groupBy(F.col("tie").alias("t")).agg(F.collect_list("run").alias("repeated")), "repeated")
    size = repeated.agg(F.coalesce(F.sum(F.size("repeated")), F.lit(0))).first()[0]
    few = F.broadcast(repeated) if is_broadcastable(size) else repeated
    marked = (rows.join(F.broadcast(furniture), F.col("host") == F.col("h"), "left").join(few, F.col("tie") == F.col("t"), "left")
              .select("page_id", "url", "html", "buckets", "furniture", "repeated"))
    return marked.mapInArrow(_marked_texts, "page_id long, url string, text string, n_chars long")


def _marked_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Main texts of pages with the site runs of their host and their own repeated runs."""
    for batch in batches:
        for start, stop in text_slices(batch.column("html"), SLICE_BYTES):
            part = batch.slice(start, stop - start)
            texts = [_marked_text(page_blocks(h), *marks) for h, *marks in zip(
                *(part.column(c).to_pylist() for c in ("html", "buckets", "furniture", "repeated")))]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def _marked_text(blocks: list[tuple[int, str]], buckets: int, furniture: list[int] | None, repeated: list[int] | None) -> str:
    articled = any(z == ARTICLE for z, _ in blocks)
    zone, marks = (ARTICLE, furniture) if articled else (OPEN, repeated)
    if not marks or not blocks:
        return "\n".join(t for z, t in blocks if z == zone)
    value, starts, _, first = _stream([blocks])
    bucket, low = _run_numbers(value, np.int64(buckets))
    starts &= np.isin((bucket << 48) | low, np.array(marks, dtype=np.int64))
    upto = np.cumsum(np.append(0, covered(starts)))
    hidden, length = (np.diff(x).tolist() for x in (upto[first], first))
    return "\n".join(t for (z, t), n, m in zip(blocks, hidden, length) if z == zone and (n < m if articled else 2 * n <= m))


def extract_pages(pages: DataFrame, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html)``.

    One task holds one host of up to ``group_chars`` characters of html, or a bucket of the runs
    of a larger one; the texts are the same either way.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    rows = rows.withColumn("tie", F.xxhash64("page_id", "url", "html"))
    sizes = (rows.groupBy("host").agg(F.sum(F.length("html").cast("long")).alias("chars")).where(F.col("chars") > group_chars)
             .select(F.col("host").alias("h"), F.ceil(F.col("chars") / (BUCKET_GROUPS * group_chars)).alias("buckets")))
    sizes = write_table(sizes, "hosts")
    large = sizes.count()
    schema = "page_id long, url string, text string, n_chars long"
    if not large:
        return rows.select("page_id", "url", "html", "tie", "host").groupBy("host").applyInPandas(_extract, schema)
    sizes = F.broadcast(sizes) if is_broadcastable(large) else sizes
    small = (rows.join(sizes, F.col("host") == F.col("h"), "left_anti").select("page_id", "url", "html", "tie", "host")
             .groupBy("host").applyInPandas(_extract, schema))
    return small.union(_large_hosts(rows.join(sizes, F.col("host") == F.col("h")).drop("h")))
