"""Main text of web pages: markup tells what it can, host-wide repetition the rest.

Each page is cut into blocks of text by its markup, whether well formed or not.
Scripts, styles, forms, menus, page headers and footers, sidebars, adverts, notices
and reader comments are left out by their tags, and blocks by their class names (elements
inside a line only where the names tell an advert). Blocks inside the page's ``article``
(else ``main``) are its text. An article inside another, or named as a comment or teaser,
is a reader's. Names and forms give way where nothing else is left: the only article of
a page stays, whatever holds it. Time and memory are in proportion to the page, also for
broken tags.

The blocks' words are then joined, page after page of one host, and a suffix array
over them finds every run of at least ``MIN_RUN`` words that appears on two or more
different pages. What such runs cover is boilerplate (whole blocks, or runs inside one) and
only the page's own words are kept. This is then held against the markup: of a page that
names its article (or ``main``), blocks inside it get back their shared runs, as a passage
may well be printed on several pages, and blocks outside it go.

All pages are dealt to windows of about ``MAX_WORDS`` words: a host that has more lies in several, by a hash of the
page's content, smaller ones share some. Copies so meet in a window and are laid out once; very many of them are spread
over as many windows as they fill eighths of one. A suffix array covers a host's pages in one window. That bounds memory only: of a host in
several windows each tells its runs, and those of two or more contents are found over the whole host. As most runs are
in one window only, this takes two rounds. In the first a window tells a number of some thirty bits for each run, packed
in order to two or three bytes, and hears which of them other windows have too. In the second it tells the runs of those
alone, by that number and a 64-bit hash independent of it, with the least and the greatest content they are in; what is
merged of these decides, and goes back as the runs' places in the window's order. The pages' words are dealt once,
compressed, and read again in each round.

A null or empty page has an empty text; a page without an own host (null url) is
compared with others without one. Pages of equal html count as one page, so exact
copies do not make each other boilerplate.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from itertools import compress, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm import arrow, rolling
from footfall.llm.urls import host_and_path

MIN_RUN = 8
MAX_WORDS = 1 << 18
# Code points of a page that are counted as one word when windows are sized; a word and the space after it take two at least.
CHARS_A_WORD = 6
# Bits by which a run's number exceeds the runs of its host, so that few numbers are in two windows by chance.
SPARE_BITS = 8
# Windows of a host whose numbers one task compares at once.
COMPARED = 8
# The copies of one page fill such a part of a window at most.
COPIES = 8

# What the tags of HTML mean.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_NEXT = {
    "p": BLOCK, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option", "optgroup"}),
}
HOLDS = frozenset("article aside body div dl fieldset footer form header main menu nav ol section table td th ul".split())
LEFT_OUT = frozenset(
    "aside audio button canvas dialog footer head label map menu nav object option search select svg video".split()
)
# Words of a class, id or role that name what is not the article.
LEFT_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies disqus footer gdpr login menu menubar modal nav navbar "
    "navigation newsletter notice notices overlay pager pagination popup promo promos promotion recommended related "
    "replies reply search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar "
    "tracking widget widgets".split()
)
PAGE_HEADER_WORDS = frozenset({"header", "masthead", "topbar"})
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertisements advertising".split())
# Those of the words that no holder of the article bears.
NEVER_WORDS = ADVERT_WORDS | frozenset(
    "banner banners breadcrumb breadcrumbs comment comments consent cookie cookies disqus gdpr newsletter notice notices "
    "promo promos promotion recommended related replies reply sponsor sponsored subscribe subscription".split()
)

_NAME = r"([a-zA-Z][a-zA-Z0-9:-]*+)"
_TAG = re.compile(
    rf"""<!--|<[!?][^>]*>|</?{_NAME}((?:[^>"']++|"[^"<]*"|'[^'<]*')*+)>|</?{_NAME}([^>]*)>""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_END = {name: re.compile(rf"</{name}\s*>|\Z", re.I) for name in RAW}
_ZEROS = re.compile(r"&#0+(?=[0-9])")
_HUGE = re.compile(r"&#[0-9]{8,}+;?")

# How doubtful an element is, and in which order doubts give way: (place, doubts set aside).
FORM, NAMED, NEVER = 1, 2, 3
_TRIES = ((2, 0), (2, FORM), (2, NAMED), (1, 0), (1, FORM), (2, NEVER), (1, NAMED), (1, NEVER))


class Block(NamedTuple):
    text: str
    where: int  # 2 inside an article, 1 inside main, 0 elsewhere


class Doubt:
    """An element that is left out, unless it holds the only article (or ``main``) of its page."""

    __slots__ = ("around", "gone", "holds", "weight")

    def __init__(self, weight: int, around: Doubt | None, holds: bool = False):
        self.weight, self.around, self.holds, self.gone = weight, around, holds, True


class Open(NamedTuple):
    """An element that is open, and what holds for the text in it."""

    tag: str
    left_out: bool
    where: int
    doubt: Doubt | None
    closable: int  # the innermost open element, this one included, that may end for the next tag or bars its search


OUTSIDE = Open("", False, 0, None, -1)


def _name_doubt(tag: str, attributes: str, in_article: bool) -> int:
    """How doubtful its class, id or role makes an element: 0, ``NAMED`` or ``NEVER``.

    A name counts only as a whole: every part of it, numbers aside, must tell what is not
    the article, so ``cookie-notice`` and ``comment-12`` do, ``no-sidebar`` does not. Inside
    a line (a word of a listing, a name in a sentence) only names of adverts count.
    """
    if tag in ("html", "body", "main") or "=" not in attributes:
        return 0
    if tag == "article":
        words = NEVER_WORDS
    elif tag not in BLOCK:
        words = ADVERT_WORDS
    else:
        words = LEFT_OUT_WORDS if in_article else LEFT_OUT_WORDS | PAGE_HEADER_WORDS
    worst = 0
    for found in _NAMES.findall(attributes):
        for name in "".join(found).lower().split():
            parts = [part for part in _WORDS.findall(name) if not part.isdigit()]
            if parts and words.issuperset(parts):
                worst = max(worst, NAMED if NEVER_WORDS.isdisjoint(parts) else NEVER)
    return worst


def decoded(text: str) -> str:
    """``text`` with its character references decoded; numbers of any length are taken."""
    if "&#" in text:
        text = _HUGE.sub("�", _ZEROS.sub("&#", text))
    return unescape(text)


def _pieces(html: str) -> tuple[list[tuple[list[tuple[str, Doubt | None]], int]], list[Doubt]]:
    """The pieces of text of each block, with the doubtful element they are in, and the block's place.

    One pass: a tag is looked for only up to the last ``>``, a closing tag only where an
    element of its name is open, and what a new tag ends by links between such elements.
    """
    found_blocks: list[tuple[list[tuple[str, Doubt | None]], int]] = []
    parts: list[tuple[str, Doubt | None]] = []
    stack: list[Open] = [OUTSIDE]
    opened: dict[str, int] = {}
    doubts: list[Doubt] = []
    at, last = 0, html.rfind(">") + 1
    size = html.find("<!--", last)  # nothing can end a comment there
    size = len(html) if size < 0 else size

    def end_block() -> None:
        if parts:
            found_blocks.append((parts.copy(), stack[-1].where))
            parts.clear()

    def close(depth: int) -> None:
        for element in stack[depth:]:
            opened[element.tag] -= 1
        del stack[depth:]

    while True:
        found = _TAG.search(html, at, last)
        now = stack[-1]
        end = found.start() if found else size
        if at < end and not now.left_out:
            parts.append((html[at:end], now.doubt))
        if not found:
            break
        at = found.end()
        tag = (found[1] or found[3] or "").lower()
        if not tag:  # a comment or declaration
            if found[0] == "<!--":
                at = html.find("-->", end + 2) + 3
                if at < 3:
                    break
            continue
        if html[end + 1] == "/":
            if opened.get(tag):
                if tag in BLOCK:
                    end_block()
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close(depth)
            continue
        if tag in RAW:
            at = _END[tag].search(html, at).end()
            continue
        if tag in ("br", "wbr", "hr"):
            if not now.left_out:
                parts.append((" " if tag != "wbr" else "", now.doubt))
            if tag == "hr":
                end_block()
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            end_block()
            i = now.closable
            while i > 0:
                if tag in CLOSED_BY_NEXT.get(stack[i].tag, ()):
                    close(i)
                    break
                if stack[i].tag in HOLDS:
                    break
                i = stack[i - 1].closable
            now = stack[-1]
        attributes = found[2] or found[4] or ""
        if attributes.endswith("/") and tag not in BLOCK:
            continue
        inside = now.where == 2
        left_out = now.left_out or tag in LEFT_OUT or (tag == "header" and not inside)
        doubt = now.doubt
        if not left_out:
            weight = _name_doubt(tag, attributes, inside)
            if tag == "article" and inside:
                weight = NEVER
            if weight or tag == "form":
                doubt = Doubt(weight or FORM, doubt)
                doubts.append(doubt)
            if tag in ("article", "main"):
                holder = doubt
                while holder and not holder.holds:
                    holder.holds, holder = True, holder.around
        where = 2 if tag == "article" else max(now.where, 1) if tag == "main" else now.where
        closable = len(stack) if tag in HOLDS or tag in CLOSED_BY_NEXT else now.closable
        stack.append(Open(tag, left_out, where, doubt, closable))
        opened[tag] = opened.get(tag, 0) + 1
    end_block()
    return found_blocks, doubts


def blocks_of(html: str) -> list[Block]:
    """The blocks of text of a page that its markup does not leave out, in page order.

    White space inside a block is one space, character references are decoded. Where no
    article (else ``main``) with a text stays, doubts about what holds one are set aside,
    those about forms first and those about comments, teasers and notices last.
    """
    found_blocks, doubts = _pieces(html)

    def kept(aside: int) -> list[Block]:
        for doubt in doubts:  # an element comes after those around it
            dropped = doubt.weight > aside or not doubt.holds
            doubt.gone = dropped or (doubt.around is not None and doubt.around.gone)
        out = []
        for pieces, place in found_blocks:
            text = " ".join(decoded("".join(piece for piece, doubt in pieces if not (doubt and doubt.gone))).split())
            if text:
                out.append(Block(text, place))
        return out

    strict = kept(0)
    if not doubts:
        return strict
    tried = {0: strict}
    for place, aside in _TRIES:
        blocks = tried[aside] if aside in tried else tried.setdefault(aside, kept(aside))
        if any(block.where == place for block in blocks):
            # Doubts are set aside for this place alone.
            return [block for block in blocks if block.where == place] if aside else blocks
    return strict


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): where the keys stand in stable order, and the rank of each among the distinct ones."""
    bits = len(keys).bit_length()
    if len(keys) and keys.min() >= 0 and int(keys.max()) < 1 << (63 - bits):
        both = np.sort(keys << bits | np.arange(len(keys)))  # of plain numbers, several times as fast as argsort
        order, keys = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.diff(keys, prepend=keys[:1]) != 0)
    return order, rank


def suffix_order(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): all suffixes sorted by their first ``depth`` words (a power of two).

    Prefix doubling: the rank by 2h words comes from the ranks by h words of a suffix
    and of the one h words later. Suffixes that agree in ``depth`` words share a rank.
    """
    order, rank = _ranked(words)
    h = 1
    while h < depth:
        later = np.zeros(len(rank), np.int64)
        later[: len(rank) - h] = rank[h:] + 1
        order, rank = _ranked(rank * (len(rank) + 2) + later)
        h *= 2
    return order, rank


def equal_runs(words: np.ndarray, page: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, first): where runs inside one page start, equal runs together, and which is a run's first."""
    if len(words) < run:
        return np.empty(0, np.int64), np.empty(0, bool)
    order, rank = suffix_order(words, run)
    whole = np.zeros(len(words), bool)
    whole[: len(words) - run + 1] = page[: len(words) - run + 1] == page[run - 1 :]
    order = order[whole[order]]
    return order, np.diff(rank[order], prepend=-1) != 0


def repeated_words(words: np.ndarray, page: np.ndarray, run: int = MIN_RUN) -> np.ndarray:
    """Which words lie in a run of ``run`` words that appears on two or more pages."""
    order, first = equal_runs(words, page, run)
    if not len(order):
        return np.zeros(len(words), bool)
    pages, begin = page[order], np.flatnonzero(first)
    shared = np.minimum.reduceat(pages, begin) != np.maximum.reduceat(pages, begin)
    return rolling.covered(order[shared[np.cumsum(first) - 1]], run, len(words))


def whole_runs(covered: np.ndarray, run: int) -> np.ndarray:
    """Covered words of a block without stretches of fewer than ``run`` words, unless all are covered.

    A run may reach from the block before into the first words of this one by chance.
    """
    if covered.all() or not covered.any():
        return covered
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    out = np.zeros(len(covered), bool)
    for start, end in edges.reshape(-1, 2).tolist():
        out[start:end] = end - start >= run
    return out


class Laid(NamedTuple):
    """The words of some pages, one after the other."""

    words: np.ndarray  # the number of each word, the end of a block being one
    known: pa.Array  # the word of each number
    page: np.ndarray  # which page each word is on
    spans: list[list[tuple[int, int]]]  # of each page, where its blocks lie


def lay_out(pages: list[list[str]]) -> Laid:
    """The words of the blocks of pages."""
    sizes, spans, at = [], [], 0
    for blocks in pages:
        mine = []
        for text in blocks:
            mine.append((at, at + text.count(" ") + 1))
            at = mine[-1][1] + 1
        sizes.append(at - mine[0][0] if mine else 0)
        spans.append(mine)
    # The end of a block is a word of its own, so runs of short blocks count.
    texts = pa.array([" \n ".join([*blocks, ""])[:-1] if blocks else None for blocks in pages], pa.large_string())
    words = pc.split_pattern(texts, " ").flatten().dictionary_encode()
    numbers = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Laid(numbers, words.dictionary, np.repeat(np.arange(len(pages)), sizes), spans)


def text_without(blocks: list[Block], spans: list[tuple[int, int]], covered: np.ndarray, run: int) -> str:
    """The words of a page's blocks that no shared run covers, held against the markup.

    Where that names the article (else ``main``), shared runs in it are put back and what lies outside goes.
    """
    best = max((block.where for block in blocks), default=0)
    kept = []
    for block, (start, end) in zip(blocks, spans, strict=True):
        stays = np.full(1, block.where == best) if best else ~whole_runs(covered[start:end], run)
        if stays.all():
            kept.append(block.text)
        elif stays.any():
            kept.append(" ".join(compress(block.text.split(" "), stays.tolist())))
    return "\n\n".join(text for text in kept if text)


def own_texts(pages: list[tuple[int, list[Block]]], run: int = MIN_RUN) -> list[str]:
    """The main text of each (identity, blocks) of one host, worked out in one suffix array."""
    laid = lay_out([[block.text for block in blocks] for _, blocks in pages])
    identity = np.array([identity for identity, _ in pages], np.int64)
    covered = repeated_words(laid.words, identity[laid.page], run)
    return [text_without(blocks, spans, covered, run) for (_, blocks), spans in zip(pages, laid.spans, strict=True)]


def _two_hashes(words: pa.Array) -> np.ndarray:
    """Two independent 64-bit hashes of each word."""
    data, offsets = arrow.bytes_of(words)
    return np.stack([
        rolling.span_hashes(rolling.byte_sums(data, which), offsets[:-1], offsets[1:], which) for which in (0, 1)
    ])


def run_keys(laid: Laid, host: str | None, run: int = MIN_RUN) -> tuple[np.ndarray, np.ndarray]:
    """(starts, keys): where runs inside one page start, and two 64-bit hashes of the run and the host."""
    of_word = _two_hashes(laid.known)[:, laid.words]
    of_host = _two_hashes(pa.array(["" if host is None else f"/{host}"], pa.large_string()))
    starts, keys = np.empty(0, np.int64), []
    for hashes, own in zip(of_word, of_host, strict=True):
        starts, found = rolling.gram_hashes(rolling.gram_sums(hashes), laid.page, run)
        keys.append(found ^ own)
    return starts, np.stack(keys)


class Runs(NamedTuple):
    """The runs of some pages of a host, each once, in the order of their two hashes."""

    starts: np.ndarray  # where runs start, each place of each run
    which: np.ndarray  # the run that starts there
    keys: np.ndarray  # the two hashes of each run
    low: np.ndarray  # the least and the greatest content that it is in
    high: np.ndarray


def window_runs(laid: Laid, contents: list[int], host: str | None) -> Runs:
    """Every run of some pages of a host, found by a suffix array."""
    order, first = equal_runs(laid.words, laid.page, MIN_RUN)
    if not len(order):
        empty = np.empty(0, np.int64)
        return Runs(empty, empty, np.empty((2, 0), np.uint64), empty, empty)
    starts, keys = run_keys(laid, host)
    begin = np.flatnonzero(first)
    at = np.empty(len(laid.words), np.int64)
    at[starts] = np.arange(len(starts))
    keys = keys[:, at[order[begin]]]
    content = np.array(contents, np.int64)[laid.page[order]]
    by = np.argsort(keys[0])
    if (np.diff(keys[0][by]) == 0).any():  # two runs of one hash
        by = np.lexsort(keys[::-1])
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    low, high = (least.reduceat(content, begin)[by] for least in (np.minimum, np.maximum))
    return Runs(order, place[np.cumsum(first) - 1], keys[:, by], low, high)


def texts_without(pages: list[list[Block]], contents: list[int], host: str | None, shared: np.ndarray) -> list[str]:
    """The texts of some pages of a host without the runs that two of them share or whose places are in ``shared``."""
    laid = lay_out([[block.text for block in blocks] for blocks in pages])
    if len(shared):
        runs = window_runs(laid, contents, host)
        gone = runs.low != runs.high
        gone[shared] = True
        covered = rolling.covered(runs.starts[gone[runs.which]], MIN_RUN, len(laid.words))
    else:
        covered = repeated_words(laid.words, np.array(contents, np.int64)[laid.page])
    return [text_without(blocks, spans, covered, MIN_RUN) for blocks, spans in zip(pages, laid.spans, strict=True)]


def packed(numbers: np.ndarray, bits: int) -> bytes:
    """Numbers of so many ``bits`` in ascending order: their low bits, then how far apart the high ones are."""
    low = max(0, bits - len(numbers).bit_length())
    lows = np.empty((low, len(numbers)), np.uint8)
    for bit in range(low):
        lows[bit] = numbers >> bit & 1
    at = (numbers >> low) + np.arange(len(numbers))
    marks = np.zeros(int(at.max(initial=-1)) + 1, np.uint8)
    marks[at] = 1
    return struct.pack("<QB", len(numbers), low) + np.packbits(lows).tobytes() + np.packbits(marks).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    """The numbers that ``packed`` wrote."""
    n, low = struct.unpack_from("<QB", raw)
    data = np.frombuffer(raw, np.uint8, offset=9)
    end = (n * low + 7) // 8
    numbers = (np.flatnonzero(np.unpackbits(data[end:])) - np.arange(n)) << low
    for bit, found in enumerate(np.unpackbits(data[:end], count=n * low).reshape(low, n)):
        numbers |= found.astype(np.int64) << bit
    return numbers


def _among(numbers: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ascending ``numbers`` are among the ascending ``known`` ones."""
    if not len(known):
        return np.zeros(len(numbers), bool)
    return known[np.minimum(np.searchsorted(known, numbers), len(known) - 1)] == numbers


class Split(NamedTuple):
    """How the runs of a host in some windows are numbered and dealt."""

    bits: int  # of a run's number within its bucket
    bucket_bits: int

    @staticmethod
    def of(parts: int) -> Split:
        doubled = (parts - 1).bit_length()
        buckets = max(0, doubled - COMPARED.bit_length() + 1)
        return Split((MAX_WORDS - 1).bit_length() + SPARE_BITS + doubled - buckets, buckets)

    def numbers(self, runs: Runs) -> np.ndarray:
        """The numbers of runs, bucket before bucket, ascending."""
        return (runs.keys[0] >> np.uint64(64 - self.bits - self.bucket_bits)).view(np.int64)

    def cuts(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(bucket, first, last) of ascending numbers in every bucket that has some."""
        cuts = np.searchsorted(numbers, np.arange((1 << self.bucket_bits) + 1) << self.bits).tolist()
        return ((i, *cut) for i, cut in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if cut[0] < cut[1])


def _in_windows(rows: DataFrame, max_words: int) -> DataFrame:
    """``rows`` with the ``window`` of each, and the number of windows (``parts``) that its host is dealt to.

    Hosts that fill a window and pages whose copies fill a part of one are told to all tasks: their number is bounded
    by the size of the table over that of such a part.
    """
    most = F.lit(max_words * CHARS_A_WORD)
    chars = F.coalesce(F.length("html"), F.lit(0)).cast("long") + 1
    copies = rows.groupBy("host", "content").agg(F.sum(chars).alias("size"), F.count("*").alias("n"))
    sizes = copies.groupBy("host").agg(F.sum("size").alias("size"))
    large = sizes.where(F.col("size") > most).select(
        F.col("host").alias("place"), F.ceil(F.col("size") / most).alias("dealt")
    )
    small = sizes.where(F.col("size") <= most).agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"))
    small = small.select(F.ceil((F.col("size") + 1) / most).alias("shared"))
    many = copies.where((F.col("n") > 1) & (F.col("size") * COPIES > most)).select(
        F.col("host").alias("here"), F.col("content").alias("same"), F.ceil(F.col("size") * COPIES / most).alias("spread")
    )
    found = rows.join(F.broadcast(large), F.col("host").eqNullSafe(F.col("place")), "left")
    same = F.col("host").eqNullSafe(F.col("here")) & F.col("content").eqNullSafe(F.col("same"))
    found = found.join(F.broadcast(many), same, "left").crossJoin(F.broadcast(small))
    spread = F.pmod(F.xxhash64("id", "url"), F.coalesce("spread", F.lit(1)).cast("long"))
    window = F.when(F.col("dealt").isNull(), F.xxhash64(F.pmod(F.xxhash64("host"), "shared"))).otherwise(
        F.xxhash64("host", F.pmod(F.xxhash64("content", spread), "dealt"))
    )
    parts = F.coalesce("dealt", F.lit(1)).cast("long")
    return found.select(*rows.columns, window.alias("window"), parts.alias("parts"))


def _parsed(rows: DataFrame) -> DataFrame:
    """``rows`` with the places and compressed texts of the blocks instead of the html, dealt by window."""
    names = [name for name in rows.columns if name != "html"]
    schema = T.StructType([
        *rows.select(*names).schema, T.StructField("places", T.BinaryType()), T.StructField("texts", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            places, texts = [], []
            for html in batch.column(len(names)):
                blocks = blocks_of(html.as_py() or "")
                body = "\n".join(block.text for block in blocks).encode("utf-8", "surrogatepass")
                places.append(bytes(block.where for block in blocks))
                texts.append(struct.pack("<Q", len(body)) + codec.compress(body, asbytes=True))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(places, pa.binary()), pa.array(texts, pa.binary())],
                names=schema.names,
            )

    pages = rows.select(*names, "html").mapInArrow(arrow.tidy(run), schema)
    return pages.repartition("window")


def _texts_of(raw: bytes) -> list[str]:
    """The texts of a page's blocks."""
    (size,) = struct.unpack_from("<Q", raw)
    if not size:
        return []
    body = pa.Codec("zstd").decompress(raw[8:], decompressed_size=size, asbytes=True)
    return body.decode("utf-8", "surrogatepass").split("\n")


def _by_host(pages: pa.Table) -> Iterator[tuple[str | None, int, pa.Table]]:
    """(host, number of its windows, pages) of each host in a window."""
    places: dict[str | None, list[int]] = {}
    for i, host in enumerate(pages.column("host").to_pylist()):
        places.setdefault(host, []).append(i)
    for host, at in places.items():
        mine = pages.take(at)
        yield host, mine.column("parts")[0].as_py(), mine


def _different(pages: pa.Table) -> tuple[list[tuple[int, bytes, bytes]], list[int]]:
    """(content, places, texts) of the pages that are no copies, and which of them each page is."""
    known: dict[tuple[int, bytes, bytes], int] = {}
    columns = (pages.column(name).to_pylist() for name in ("content", "places", "texts"))
    which = [known.setdefault(page, len(known)) for page in zip(*columns, strict=True)]
    return list(known), which


def _runs_of(pages: pa.Table, host: str | None) -> Runs:
    contents, _, texts = zip(*_different(pages)[0], strict=True)
    return window_runs(lay_out([_texts_of(raw) for raw in texts]), list(contents), host)


# What a window tells of its runs, or hears of them: a bucket of a host, and packed numbers.
_HEAD = [("host", pa.string()), ("parts", pa.int64()), ("bucket", pa.int64()), ("window", pa.int64())]
_NUMBERS = pa.schema([*_HEAD, ("runs", pa.binary())])
_EXACT = pa.schema([*_HEAD, ("runs", pa.binary()), ("places", pa.binary()), ("exact", pa.binary())])
_PLACES = pa.schema([*_HEAD, ("places", pa.binary())])
_HEAD_DDL = "host string, parts long, bucket long, window long"
_NUMBERS_DDL = f"{_HEAD_DDL}, runs binary"
_EXACT_DDL = f"{_HEAD_DDL}, runs binary, places binary, exact binary"
_PLACES_DDL = f"{_HEAD_DDL}, places binary"


def _runs(windows: DataFrame) -> DataFrame:
    """The packed numbers of the runs of each window, by bucket; a host in one window has none to tell."""
    names = ["window", "host", "parts", "content", "places", "texts"]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window, rows in groupby(rows_of(batches), key=lambda row: row[0]):
            pages = pa.table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))
            for host, parts, mine in _by_host(pages):
                if parts == 1:
                    continue
                split = Split.of(parts)
                numbers = split.numbers(_runs_of(mine, host))
                numbers = numbers[np.diff(numbers, prepend=-1) != 0]
                told = [
                    (host, parts, bucket, window, packed(numbers[start:end] - (bucket << split.bits), split.bits))
                    for bucket, start, end in split.cuts(numbers)
                ]
                if told:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, kind) for x, kind in zip(zip(*told, strict=True), _NUMBERS.types, strict=True)],
                        schema=_NUMBERS,
                    )

    return windows.sortWithinPartitions("window").mapInArrow(arrow.tidy(run), _NUMBERS_DDL)


def _in_two_windows(told: pa.Table) -> pa.Table:
    """Of one bucket of a host: the numbers that several windows told, for each of these windows."""
    rows = told.to_pylist()
    bits = Split.of(rows[0]["parts"]).bits
    numbers = [unpacked(row["runs"]) for row in rows]
    every = np.sort(np.concatenate(numbers))
    twice = every[1:][every[1:] == every[:-1]]
    twice = twice[np.diff(twice, prepend=-1) != 0]
    found = [mine[_among(mine, twice)] for mine in numbers]
    return pa.Table.from_pylist(
        [row | {"runs": packed(mine, bits)} for row, mine in zip(rows, found, strict=True) if len(mine)], _NUMBERS
    )


def _exact(pages: pa.Table, met: pa.Table) -> pa.Table:
    """Of one window: the runs whose numbers other windows told too, exactly."""
    wanted = defaultdict(list)
    for row in met.to_pylist():
        wanted[row["host"]].append(unpacked(row["runs"]) + (row["bucket"] << Split.of(row["parts"]).bits))
    out = []
    for host, parts, mine in _by_host(pages) if wanted else ():
        if host not in wanted:
            continue
        split, runs = Split.of(parts), _runs_of(mine, host)
        numbers = split.numbers(runs)
        places = np.flatnonzero(_among(numbers, np.sort(np.concatenate(wanted[host]))))
        exact = np.stack([runs.keys[1].view(np.int64), runs.low, runs.high - runs.low])
        for bucket, start, end in split.cuts(numbers[places]):
            at = places[start:end]
            out.append({
                "host": host, "parts": parts, "bucket": bucket, "window": pages.column("window")[0].as_py(),
                "runs": packed(numbers[at] - (bucket << split.bits), split.bits),
                "places": packed(at, len(numbers).bit_length()), "exact": exact[:, at].tobytes(),
            })
    return pa.Table.from_pylist(out, _EXACT)


def _in_two_contents(told: pa.Table) -> pa.Table:
    """Of one bucket of a host: the places of the runs of two or more contents, for each of their windows."""
    rows = told.to_pylist()
    numbers = np.concatenate([unpacked(row["runs"]) for row in rows])
    second, low, spread = np.concatenate([np.frombuffer(row["exact"], np.int64).reshape(3, -1) for row in rows], axis=1)
    order = np.lexsort((second, numbers))
    first = (np.diff(numbers[order], prepend=-1) != 0) | (np.diff(second[order], prepend=second[order][:1]) != 0)
    begin = np.flatnonzero(first)
    shared = np.minimum.reduceat(low[order], begin) != np.maximum.reduceat((low + spread)[order], begin)
    gone = np.empty(len(order), bool)
    gone[order] = shared[np.cumsum(first) - 1]
    out, start = [], 0
    for row in rows:
        places = unpacked(row["places"])
        places, start = places[gone[start : start + len(places)]], start + len(places)
        if len(places):
            packed_places = packed(places, int(places[-1]).bit_length())
            out.append({name: row[name] for name, _ in _HEAD} | {"places": packed_places})
    return pa.Table.from_pylist(out, _PLACES)


def _texts(windows: DataFrame, schema: T.StructType) -> DataFrame:
    """The texts of all pages: by the runs of their hosts, then held against the markup."""
    bucket = ["host", "bucket"]
    met = _runs(windows).groupBy(*bucket).applyInArrow(_in_two_windows, _NUMBERS_DDL)
    told = windows.groupBy("window").cogroup(met.groupBy("window")).applyInArrow(_exact, _EXACT_DDL)
    shared = told.groupBy(*bucket).applyInArrow(_in_two_contents, _PLACES_DDL)

    def own(pages: pa.Table, shared: pa.Table) -> pa.Table:
        known = defaultdict(lambda: [np.empty(0, np.int64)])
        for row in shared.to_pylist():
            known[row["host"]].append(unpacked(row["places"]))
        out = []
        for host, _, mine in _by_host(pages):
            different, which = _different(mine)
            blocks = [[Block(*block) for block in zip(_texts_of(raw), places, strict=True)] for _, places, raw in different]
            found = texts_without(blocks, [content for content, _, _ in different], host, np.concatenate(known[host]))
            texts = [found[i] for i in which]
            out.append(pa.table([
                mine.column("id"), mine.column("url"), pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ], names=schema.names))
        return pa.concat_tables(out)

    return windows.groupBy("window").cogroup(shared.groupBy("window")).applyInArrow(own, schema)


def main_texts(
    df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", max_words: int = MAX_WORDS
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page; other columns are left out.

    Repeated rows are answered each; an empty table gives no rows.
    """
    schema = T.StructType([
        df.schema[page_id], df.schema[url],
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])
    arrow.small_batches(df.sparkSession)
    rows = df.select(
        arrow.column(page_id).alias("id"), arrow.column(url).alias("url"),
        host_and_path(arrow.column(url))[0].alias("host"), F.xxhash64(arrow.column(html)).alias("content"),
        arrow.column(html).alias("html"),
    )
    return _texts(_parsed(_in_windows(rows, max_words)), schema)
