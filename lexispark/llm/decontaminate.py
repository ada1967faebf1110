"""Operator 6, benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are normalised (lower case, white space to one
space).  An item is cut into segments of ``segment`` characters or more (an
item shorter than two segments is one segment).  A document leaks an item if
some part of it is within ``floor(max_error * length)`` edits of one of the
item's segments.

Filter: with k edits, a segment of m characters and its copy share at least
m + 1 - q - k * q q-grams (q is 8, or the largest smaller power of two for
which that is at least one), and all of them on at most k + 1 neighbouring
diagonals (place in the document minus place in the segment).  Shared q-grams
are counted in diagonal bands of width 2 (k + 1) that overlap by half, so the
copy's q-grams fall into one band whole; bands that meet the bound are
verified by banded alignment: an edit distance whose start and end in the
document are free and whose diagonals stay in the band.  The filter misses
nothing and the alignment is exact, so the result equals a full search.

The benchmark is a stated query set: it is cut into blocks of at most
``BLOCK_CHARS`` characters, each is sent to the tasks in turn, and every block
is searched in all documents.  Documents are searched in pieces of bounded
length that overlap by more than a segment.

Defined results: null and empty texts leak nothing; items (normalised) that are
shorter than ``min_item`` characters are too short to allow edits: with
``short_items`` they leak where they stand exactly, between word bounds (one
place is reported), else they are not searched; equal items are all reported; repeated rows have their own results;
empty documents or an empty benchmark give an empty result.  Only the named
columns are read, so others may have any name."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

BLOCK_CHARS = 4_000_000
PIECE_CHARS = 1 << 20
MAX_HITS = 8_000_000  # shared q-grams held at a time; pieces with more are halved
Q = 8  # a power of two
MIX = np.uint64(0x9E3779B97F4A7C15)
TABLE_LOG2 = 20


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def cut_item(text: str, segment: int) -> list[str]:
    """``text`` in equal parts of ``segment`` characters or more."""
    parts = max(1, len(text) // segment)
    at = [len(text) * i // parts for i in range(parts + 1)]
    return [text[a:b] for a, b in zip(at, at[1:])]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgram_hashes(cp: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each q-gram; equal q-grams have equal hashes, and what
    the hash confuses fails the alignment."""
    n = len(cp) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, width, base = cp.astype(np.uint64), 1, 0x100000001B3
    while width < q:  # the polynomial of twice the width, from two neighbours
        h = h[:-width] * np.uint64(base) + h[width:]
        width, base = 2 * width, base * base & 0xFFFFFFFFFFFFFFFF
    return h * MIX


@dataclass
class Segments:
    """The searched segments of one block, and their q-grams in hash order.
    Those whose edit budget needs shorter q-grams are in ``rest``, numbered
    behind the others; items that are matched exactly are in ``short``."""
    items: list[int]
    texts: list[str]
    budget: np.ndarray
    bound: np.ndarray
    hashes: np.ndarray
    segment: np.ndarray
    place: np.ndarray
    seen: np.ndarray  # a bit for each hash prefix that occurs
    q: int = Q
    rest: Segments | None = None
    short: dict[str, list[int]] | None = None

    @classmethod
    def of(cls, items: list[tuple[int, str]], segment: int, max_error: float, min_item: int,
           short_items: bool = False) -> Segments:
        ids, texts, short = [], [], {}
        for item, text in items:
            text = normalise(text)
            if len(text) >= max(min_item, 1):
                parts = cut_item(text, segment)
                ids += [item] * len(parts)
                texts += parts
            elif text and short_items:
                short.setdefault(text, []).append(item)
        s = cls._of(ids, texts, max_error, Q)
        s.short = short
        return s

    @classmethod
    def _of(cls, ids: list[int], texts: list[str], max_error: float, q: int) -> Segments:
        size = np.array([len(t) for t in texts], np.int64)
        budget = (size * max_error).astype(np.int64)
        fits = (size + 1 - q - budget * q >= 1) | (q == 1)
        rest = None
        if not fits.all():
            rest = cls._of([ids[i] for i in np.flatnonzero(~fits)], [texts[i] for i in np.flatnonzero(~fits)], max_error, q // 2)
            ids, texts = [ids[i] for i in np.flatnonzero(fits)], [texts[i] for i in np.flatnonzero(fits)]
            size, budget = size[fits], budget[fits]
        hs = [qgram_hashes(_codes(t), q) for t in texts]
        h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
        seg = np.repeat(np.arange(len(hs)), [len(x) for x in hs]) if hs else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(x)) for x in hs]) if hs else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        seen = np.zeros(1 << TABLE_LOG2, bool)
        seen[(h >> np.uint64(64 - TABLE_LOG2)).astype(np.int64)] = True
        return cls(ids, texts, budget, size + 1 - q - budget * q, h[order], seg[order], place[order], seen, q, rest)

    def item(self, g: int) -> int:
        """The item of segment ``g``, counted through ``rest``."""
        return self.items[g] if g < len(self.items) else self.rest.item(g - len(self.items))


def exact_places(texts: list[str], short: dict[str, list[int]]) -> list[tuple[int, int, int, int]]:
    """(index of the text, item, start, end): the first place of each short
    item in normalised ``texts`` that isn't inside a word."""
    import ahocorasick
    if not short:
        return []
    find = ahocorasick.Automaton()
    for t in short:
        find.add_word(t, t)
    find.make_automaton()
    out = []
    for i, text in enumerate(texts):
        first: dict[str, int] = {}
        for end, t in find.iter(text):
            a, b = end + 1 - len(t), end + 1
            inside = (a > 0 and text[a - 1].isalnum() and t[0].isalnum()) or (
                b < len(text) and text[b].isalnum() and t[-1].isalnum())
            if not inside:
                first.setdefault(t, a)
        out += [(i, item, a, a + len(t)) for t, a in first.items() for item in short[t]]
    return out


def align(pattern: np.ndarray, window: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best part of ``window`` within ``budget``
    edits of ``pattern``, on diagonals ``low`` to ``high`` (place in the window
    minus place in the pattern); the leftmost end of the fewest edits."""
    width = high - low + 1
    far = budget + 1
    ext = np.full(len(pattern) + width + 1, -1, np.int64)  # the window from diagonal low on, -1 outside
    a, b = max(0, low), min(len(window), low + len(ext))
    if b > a:
        ext[a - low:b - low] = window[a:b]
    steps = np.arange(width)
    cost = np.zeros(width, np.int64)  # row 0: the copy may begin anywhere
    start = steps + low
    for i, c in enumerate(pattern):
        text = ext[i:i + width]
        edits = cost + (text != c)
        edits[text == -1] = far
        begin = start.copy()
        up = np.append(cost[1:] + 1, far)  # the pattern's character is missing in the text
        better = up < edits
        edits[better], begin[better] = up[better], np.append(start[1:], 0)[better]
        best = np.minimum.accumulate(edits - steps)  # characters added in the text
        run = best + steps
        if (run < edits).any():
            source = np.maximum.accumulate(np.where(edits - steps == best, steps, 0))
            begin = np.where(run < edits, begin[source], begin)
            edits = run
        cost, start = np.minimum(edits, far), begin
        if cost.min() > budget:
            return None
    k = int(cost.argmin())
    return int(cost[k]), max(0, int(start[k])), min(len(window), k + low + len(pattern))


def search(texts: list[str], s: Segments) -> list[tuple[int, int, int, int, int]]:
    """(index of the text, segment, edits, start, end) of every segment found
    in normalised ``texts``: its best place in each band."""
    found = _search(texts, s)
    if s.rest is not None:
        found += [(i, g + len(s.items), *v) for i, g, *v in search(texts, s.rest)]
    return found


def _search(texts: list[str], s: Segments) -> list[tuple[int, int, int, int, int]]:
    if not len(s.hashes):
        return []
    reach = int(max(len(t) for t in s.texts) + 2 * s.budget.max() + s.q)
    pieces = [(i, a, t[a:a + PIECE_CHARS + reach]) for i, t in enumerate(texts) for a in range(0, len(t), PIECE_CHARS)]
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    groups = list(_groups(pieces))[::-1]
    while groups:
        group = groups.pop()
        cp = _codes("\0".join(p[2] for p in group))
        first = np.cumsum([0] + [len(p[2]) + 1 for p in group])
        h = qgram_hashes(cp, s.q)
        at = np.flatnonzero(s.seen[(h >> np.uint64(64 - TABLE_LOG2)).astype(np.int64)])
        lo = np.searchsorted(s.hashes, h[at], "left")
        n = np.searchsorted(s.hashes, h[at], "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if not len(at):
            continue
        if n.sum() > MAX_HITS and (len(group) > 1 or len(group[0][2]) > 4 * reach):
            groups += _halves(group, reach)
            continue
        pos = np.repeat(at, n)
        k = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        seg, diag = s.segment[k], pos - s.place[k]
        half = s.budget[seg] + 1
        # a hit lies in two overlapping bands: those that begin at half and at whole multiples of half their width
        band = np.concatenate([diag // half, diag // half - 1])
        key = (np.concatenate([seg, seg]) << 32) + band + (1 << 31)
        order = np.argsort(key)
        key = key[order]
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        seg, band = key[edge] >> 32, (key[edge] & 0xFFFFFFFF) - (1 << 31)
        count = np.diff(np.r_[edge, len(key)])
        for e in np.flatnonzero(count >= s.bound[seg]):
            g, half_band = int(seg[e]), int(s.budget[seg[e]]) + 1
            places = s.place[k[order[edge[e]:edge[e] + count[e]] % len(k)]]
            if len(np.unique(places)) < s.bound[g]:  # the lemma counts each of the segment's q-grams once
                continue
            low = int(band[e]) * half_band
            high = low + 2 * half_band - 1
            text = s.texts[g]
            for p in {int(x) for x in np.searchsorted(first, [max(low, 0), low + half_band, high], "right") - 1}:
                if not 0 <= p < len(group):
                    continue
                i, offset, piece = group[p]
                if out.get((i, g), (1,))[0] == 0:
                    continue
                a = max(0, low - int(first[p]) - int(s.budget[g]))
                window = piece[a:max(a, high - int(first[p]) + len(text) + int(s.budget[g]) + 1)]
                exact = window.find(text)
                if exact >= 0:
                    found = (0, exact, exact + len(text))
                else:
                    found = align(_codes(text).astype(np.int64), _codes(window).astype(np.int64),
                                  low - int(first[p]) - a, high - int(first[p]) - a, int(s.budget[g]))
                if found:
                    new = (found[0], offset + a + found[1], offset + a + found[2])
                    out[i, g] = min(out.get((i, g), new), new)
    return [(i, g, *v) for (i, g), v in sorted(out.items())]


def _groups(pieces):
    """Pieces put together to about PIECE_CHARS characters."""
    group, size = [], 0
    for p in pieces:
        if group and size + len(p[2]) > PIECE_CHARS:
            yield group
            group, size = [], 0
        group.append(p)
        size += len(p[2])
    if group:
        yield group


def _halves(group, reach):
    """Two groups for one; a single piece is cut with an overlap."""
    if len(group) > 1:
        return [group[len(group) // 2:], group[:len(group) // 2]]
    i, offset, piece = group[0]
    half = len(piece) // 2
    return [[(i, offset + half, piece[half:])], [(i, offset, piece[:half + reach])]]


def item_blocks(benchmark: DataFrame, item_id: str, text: str):
    """The benchmark's (id, text) rows, in lists of at most BLOCK_CHARS
    characters each, read block after block."""
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t is not null").orderBy("i", "t")
    held, size = [], 0
    for r in rows.toLocalIterator():
        if held and size + len(r["t"]) > BLOCK_CHARS:
            yield held
            held, size = [], 0
        held.append((r["i"], r["t"]))
        size += len(r["t"])
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame, max_error: float = 0.1, segment: int = 120, min_item: int = 24,
          short_items: bool = False, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, segments, edits, spans): one row for each document
    row and item that it leaks, with the number of segments found, their edits
    together, and their (start, end) in the normalised text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, item_id long, segments long, edits long, "
              "spans array<struct<start:long,end:long,edits:long>>")
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast(Segments.of(block, segment, max_error, min_item, short_items))

        def run(batches, shared=shared):
            import pyarrow as pa
            for batch in batches:
                s, ids = shared.value, batch.column("doc_id")
                found: dict[tuple[int, int], list] = {}
                texts = [normalise(t.as_py()) for t in batch.column("t")]
                for i, g, edits, a, b in search(texts, s):
                    found.setdefault((i, s.item(g)), []).append((a, b, edits))
                for i, item, a, b in exact_places(texts, s.short):
                    found.setdefault((i, item), []).append((a, b, 0))
                keys = sorted(found)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array([i for i, _ in keys], pa.int64())), pa.array([x for _, x in keys], pa.int64()),
                    pa.array([len(found[k]) for k in keys], pa.int64()),
                    pa.array([sum(e for _, _, e in found[k]) for k in keys], pa.int64()),
                    pa.array([[{"start": a, "end": b, "edits": e} for a, b, e in sorted(found[k])] for k in keys],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])))],
                    names=["doc_id", "item_id", "segments", "edits", "spans"])

        out = out.union(text_batches(rows).mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...], max_error: float = 0.1, segment: int = 120,
               min_item: int = 24, short_items: bool = False, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Columns ``keep`` of the rows of ``docs`` that leak no item.  Each block
    of the benchmark is one pass over what the one before has kept; no row is
    matched by its id, so repeated and missing ids make no difference."""
    spark = docs.sparkSession
    out = docs.select(*keep, *([] if text in keep else [text]))
    schema = out.schema
    for block in item_blocks(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast(Segments.of(block, segment, max_error, min_item, short_items))

        def run(batches, shared=shared):
            import pyarrow as pa
            for batch in batches:
                texts = [normalise(t.as_py()) for t in batch.column(text)]
                hit = {x[0] for x in search(texts, shared.value)} | {x[0] for x in exact_places(texts, shared.value.short)}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

        out = text_batches(out).mapInArrow(run, schema)
    return out.select(*keep)
