"""Operator 1, SentencePiece encoding and decoding on a relational lattice.

Encoding cuts each text into units at every place that no piece of the
vocabulary spans, so the best segmentation of a text is that of its units one
after another.  Only a block's distinct units go on; each is then encoded once
for all blocks:

* lattice: every substring of a unit of up to the longest piece's length is
  exploded and equi-joined to the piece table (the vocabulary file, a fixed
  size); the matches are the unit's edges, grouped by unit;
* fold: a Spark higher-order aggregate folds the edges.  For a unigram model
  it is Viterbi: the state has the best score and last edge for each end, and
  each further end takes its best edge.  A BPE model's scores are merge ranks,
  whose best sum is not the segmentation that the model defines; there the fold
  runs over merges: the state has the cuts, and each step removes the cut
  inside the best-ranked edge of two neighbouring symbols (the leftmost of
  equal ones).  Either gives the same ids as the model's own library;
* characters that no piece covers become byte pieces, or the unknown id.

The units' ids go back to the blocks that hold them and are strung together.
Units of over ``LONG`` characters (long runs of the same signs) have lattices
too long for a fold; they are encoded in a task with the same rules on a heap.

Decoding puts the pieces' bytes together.  Encoding replaces spaces by U+2581
and adds one before the text, as the model says; decoding undoes both, so the
round trip gives back every text without U+2581 (which returns as a space).

Defined results: null or empty text has no ids and decodes to the empty text;
repeated rows have one result each; empty input gives an empty result; ids
outside the vocabulary decode to nothing.  Only the named columns are read, so
others may have any name."""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import in_blocks
from .common import text_batches

SPACE = "▁"
BLOCK_CHARS = 8_000_000  # a task holds a block's texts, its distinct units and their ids
LONG = 96
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class Model:
    """The piece table of a ``.model`` file and how it treats white space."""
    bpe: bool
    dummy_prefix: bool
    pieces: list[tuple[str, int, float]]       # piece, id, score: those that match text
    byte_ids: list[int] | None
    unknown: int
    size: int
    surface: dict[int, bytes] = field(repr=False)  # bytes that an id decodes to

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)


def read_model(path: str) -> Model:
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    rule = proto.normalizer_spec
    if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces:
        raise ValueError("only models that keep the text as it is (identity normalisation) are supported")
    if any(p.type == USER for p in proto.pieces):
        raise ValueError("models with user-defined pieces are not supported")
    pieces, surface, byte_ids, unknown = [], {}, {}, 0
    for i, p in enumerate(proto.pieces):
        if p.type == NORMAL:
            pieces.append((p.piece, i, p.score))
            surface[i] = p.piece.replace(SPACE, " ").encode()
        elif p.type == BYTE:
            byte_ids[int(p.piece[1:-1], 16)] = i
            surface[i] = bytes([int(p.piece[1:-1], 16)])
        elif p.type == UNKNOWN:
            unknown = i
            surface[i] = proto.trainer_spec.unk_surface.encode()
    return Model(proto.trainer_spec.model_type == 2, rule.add_dummy_prefix, pieces,
                 [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None, unknown, len(proto.pieces), surface)


class Cutter:
    """Cuts texts into units at the places that no piece spans."""

    def __init__(self, model: Model) -> None:
        self.dummy = model.dummy_prefix
        chars = sorted({c for p, _, _ in model.pieces for c in p})
        self.number = np.zeros(0x110000, np.uint16 if len(chars) < 65535 else np.int32)
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.spanned = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p, _, _ in model.pieces:
            n = self.number[[ord(c) for c in p]]
            self.spanned[n[:-1], n[1:]] = True

    def units(self, text: str | None) -> list[str]:
        if not text:
            return []
        s = (SPACE if self.dummy else "") + text.replace(" ", SPACE)
        n = self.number[np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)]
        at = (np.flatnonzero(~self.spanned[n[:-1], n[1:]]) + 1).tolist()
        return [s[a:b] for a, b in zip([0, *at], [*at, len(s)])]


def character_ids(model: Model, c: str) -> list[int]:
    """Ids of a character that no piece covers."""
    if model.byte_ids is None:
        return [model.unknown]
    return [model.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")]


def encode_long(model: Model, table: dict[str, tuple[int, float]], unit: str) -> list[int]:
    """The fold's rules for one long unit: merges from a heap, or Viterbi."""
    n = len(unit)
    if not model.bpe:
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        floor = min((s for _, s in table.values()), default=0.0) - 10
        for b in range(1, n + 1):
            for a in range(max(0, b - model.longest), b):
                hit = table.get(unit[a:b])
                score = hit[1] if hit else floor if b - a == 1 else None
                if score is not None and best[a] + score > best[b]:
                    best[b], back[b] = best[a] + score, a
        cuts, b = [n], n
        while b:
            b = back[b]
            cuts.append(b)
        cuts = cuts[::-1]
    else:
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive, heap = [True] * n, []

        def offer(a: int) -> None:
            if a >= 0 and end[a] < n:
                hit = table.get(unit[a:end[end[a]]])
                if hit:
                    heapq.heappush(heap, (-hit[1], a, end[a], end[end[a]]))

        for a in range(n):
            offer(a)
        while heap:
            _, a, mid, stop = heapq.heappop(heap)
            if not alive[a] or end[a] != mid or not alive[mid] or end[mid] != stop:
                continue
            alive[mid], end[a] = False, stop
            if stop < n:
                before[stop] = a
            offer(a)
            offer(before[a])
        cuts = [a for a in range(n) if alive[a]] + [n]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        hit = table.get(unit[a:b])
        out += [hit[0]] if hit else [x for c in unit[a:b] for x in character_ids(model, c)]
    return out


def lattice(units: DataFrame, model: Model) -> DataFrame:
    """(unit, low, edges): edges (at, id, weight) of each unit in ascending order;
    ``at`` is the start times ``longest + 1`` plus the length.  The weight is
    the score, or for a BPE model its rank (0: the first merge)."""
    spark = units.sparkSession
    if model.bpe:
        rank = {s: k for k, s in enumerate(sorted({s for _, _, s in model.pieces}, reverse=True))}
        pieces = spark.createDataFrame([(p, i, rank[s]) for p, i, s in model.pieces], "piece string, id int, weight int")
    else:
        pieces = spark.createDataFrame(model.pieces, "piece string, id int, weight double")
    numbered = units.select(F.monotonically_increasing_id().alias("row"), "unit", "low")
    starts = numbered.select("row", "unit", "low", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("a"))
    spans = starts.select("row", "unit", "low", "a", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(model.longest), F.length("unit") - F.col("a")))).alias("n"))
    exploded = spans.select("row", "unit", "low", (F.col("a") * (model.longest + 1) + F.col("n")).alias("at"), "n",
                            F.substring("unit", F.col("a") + 1, F.col("n")).alias("piece"))
    joined = exploded.join(F.broadcast(pieces), "piece", "left").where(  # the vocabulary file: a fixed size
        F.col("id").isNotNull() | (F.col("n") == 1))
    edge = F.when(F.col("id").isNotNull(), F.struct("at", "id", "weight"))
    return joined.groupBy("row", "unit", "low").agg(F.sort_array(F.collect_list(edge)).alias("edges")).drop("row")


def _edge(at: Column) -> Column:
    """Place of the edge at ``at`` among the unit's edges, from 0; -1: none."""
    return F.array_position("places", at).cast("int") - 1


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def merge_cuts(length: Column, step: int) -> Column:
    """Fold over merges: the cuts left when no two neighbours make a piece.

    The state also has, for each inner cut, the rank of the merge that would
    remove it (null: no piece); a merge changes only its two neighbours' ranks."""
    none = F.array().cast("array<int>")

    def rank(a: Column, b: Column) -> Column:
        return F.get(F.col("weights"), _edge(a * step + b - a))

    def merge(s: Column, _: Column) -> Column:
        cuts, ranks = s["cuts"], s["ranks"]

        def without(k: Column) -> Column:  # cut k (from 0) goes
            left = F.when(k > 1, F.array(rank(F.get(cuts, k - 2), F.get(cuts, k + 1)))).otherwise(none)
            right = F.when(k < F.size(ranks), F.array(rank(F.get(cuts, k - 1), F.get(cuts, k + 2)))).otherwise(none)
            return F.struct(
                F.concat(F.slice(cuts, F.lit(1), k), F.slice(cuts, k + 2, F.size(cuts))).alias("cuts"),
                F.concat(F.slice(ranks, F.lit(1), F.greatest(k - 2, F.lit(0))), left, right,
                         F.slice(ranks, k + 2, F.size(ranks))).alias("ranks"))

        best = F.array_position(ranks, F.array_min(ranks)).cast("int")  # the leftmost of equal ranks
        return _bound(best, lambda k: F.when(k.isNull(), s).otherwise(without(k)))

    ranks = F.when(length < 2, none).otherwise(F.transform(F.sequence(F.lit(0), length - 2), lambda i: rank(i, i + 2)))
    first = F.struct(F.sequence(F.lit(0), length).alias("cuts"), ranks.alias("ranks"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(length - 1, F.lit(1))), first, merge, lambda s: s["cuts"])


def viterbi_cuts(length: Column, step: int, floor: float) -> Column:
    """Fold over ends: (best score, start of the last edge) for each end, then
    the cuts from the end back to the start.  A character that no piece covers
    has the score ``floor``; of equal scores the longer last edge wins."""
    state = "array<struct<score:double,start:int>>"

    def further(best: Column, b: Column) -> Column:
        def edge(a: Column) -> Column:
            own = F.get(F.col("weights"), _edge(a * step + b - a))
            own = F.coalesce(own, F.when(b - a == 1, F.lit(floor)))
            return F.struct((F.get(best, a)["score"] + own).alias("score"), (-a).alias("back"))
        starts = F.sequence(F.greatest(F.lit(0), b - step + 1), b - 1)
        edges = F.filter(F.transform(starts, edge), lambda e: e["score"].isNotNull())
        return F.concat(best, F.transform(F.array(F.array_max(edges)), lambda top: F.struct(
            top["score"].alias("score"), (-top["back"]).alias("start"))))

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"))).cast(state)
    best = F.aggregate(F.sequence(F.lit(1), length), first, lambda s, b: further(s, b).cast(state))
    return _bound(best, lambda last: F.aggregate(
        F.reverse(F.sequence(F.lit(1), length)), F.array(length), lambda cuts, b: F.when(
            F.get(cuts, F.lit(0)) == b, F.concat(F.array(F.get(last, b)["start"]), cuts)).otherwise(cuts)))


def fold(edges: DataFrame, model: Model) -> DataFrame:
    """(unit, low, ids) from (unit, low, edges)."""
    step = model.longest + 1
    floor = min((s for _, _, s in model.pieces), default=0.0) - 10
    t = edges.select("unit", "low", F.col("edges.at").alias("places"), F.col("edges.id").alias("ids"),
                     F.col("edges.weight").alias("weights"))
    n = F.length("unit")
    t = t.withColumn("cuts", merge_cuts(n, step) if model.bpe else viterbi_cuts(n, step, floor))

    def symbol(a: Column, k: Column) -> Column:
        b = F.get(F.col("cuts"), k + 1)
        known = F.get(F.col("ids"), _edge(a * step + b - a))
        if model.byte_ids is None:
            other = F.array(F.lit(model.unknown))
        else:
            code = F.hex(F.encode(F.substring("unit", a + 1, b - a), "UTF-8"))
            byte = F.array(*[F.lit(x) for x in model.byte_ids])
            other = F.transform(F.sequence(F.lit(0), (F.length(code) / 2).cast("int") - 1), lambda i: F.get(
                byte, F.conv(F.substring(code, 2 * i + 1, F.lit(2)), 16, 10).cast("int")))
        return F.when(known.isNotNull(), F.array(known)).otherwise(other)

    return t.select("unit", "low", F.flatten(F.transform(F.slice("cuts", F.lit(1), F.size("cuts") - 1), symbol)).alias("ids"))


def encode_units(units: DataFrame, model: Model) -> DataFrame:
    """(unit, low, ids) of distinct ``units`` (unit, low, size); ``low`` is
    only carried along."""
    short = units.where(F.col("size") <= LONG)
    folded = fold(lattice(short, model), model)

    def run(batches):
        import pyarrow as pa
        table = {p: (i, s) for p, i, s in model.pieces}
        for batch in batches:
            texts = batch.column("unit").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("unit"), batch.column("low"), pa.array([encode_long(model, table, u) for u in texts], pa.list_(pa.int32()))],
                names=["unit", "low", "ids"])

    return folded.union(units.where(F.col("size") > LONG).select("unit", "low").mapInArrow(run, "unit string, low int, ids array<int>"))


def encode(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id", decoded: bool = False,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids) of every row.  With ``decoded``, the ids are decoded in
    the same task, and the text (``t``) and what they decode to (``decoded``)
    are returned beside them."""
    blocks = text_batches(in_blocks(docs, doc_id, text, block_chars))
    # units are few bytes and much work, so they are dealt to more partitions than their size asks for
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def distinct(key, table):
        import pyarrow as pa
        cutter, seen = Cutter(model), set()
        for t in table.column("t"):
            seen.update(cutter.units(t.as_py()))
        return pa.table({"block": pa.array([key[0].as_py()] * len(seen), pa.int32()), "unit": pa.array(list(seen), pa.string())})

    held = blocks.groupBy("block").applyInArrow(distinct, "block int, unit string").repartition(parts, "unit")
    # all branches read block and unit and filter on aggregates only, so that they share one exchange of ``held``
    asked = held.groupBy("unit").agg(F.collect_list("block").alias("blocks"), F.min("block").alias("low"))
    units = held.groupBy("unit").agg(F.min("block").alias("low"), F.max(F.length("unit")).alias("size"))
    encoded = encode_units(units, model)
    answers = (asked.withColumn("ids", F.lit(None).cast("array<int>"))
               .unionByName(encoded.withColumn("blocks", F.lit(None).cast("array<int>")))
               .groupBy("unit", "low").agg(F.first("blocks", True).alias("blocks"), F.first("ids", True).alias("ids"))
               .select(F.explode("blocks").alias("block"), "unit", "ids"))
    kind = blocks.schema["doc_id"].dataType.simpleString()

    def string(key, left, right):
        import pyarrow as pa
        cutter = Cutter(model)
        lists = right.column("ids").combine_chunks()
        flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() if right.num_rows else np.zeros(1, int)
        place = dict(zip(right.column("unit").to_pylist(), range(right.num_rows)))
        start, size = offsets[:-1] - (offsets[0] if len(offsets) else 0), np.diff(offsets)
        out, ends = [], [0]
        for t in left.column("t"):
            rows = np.fromiter(map(place.__getitem__, cutter.units(t.as_py())), np.int64)
            n = size[rows]
            skip = np.repeat(start[rows] - np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(rows) else np.zeros(0, np.int64)
            out.append(flat[skip + np.arange(len(skip))].astype(np.int32))
            ends.append(ends[-1] + len(skip))
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out) if out else np.zeros(0, np.int32)))
        both = {"t": left.column("t"), "decoded": pa.array([decode_ids(model, x.as_py()) for x in ids], pa.string())} if decoded else {}
        return pa.table({"doc_id": left.column("doc_id"), "ids": ids, **both})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        string, f"doc_id {kind}, ids array<int>" + (", t string, decoded string" if decoded else ""))


def decode_ids(model: Model, ids: list[int] | None) -> str:
    text = b"".join([model.surface.get(i, b"") for i in ids or ()]).decode("utf-8", "replace")
    return text[1:] if model.dummy_prefix and text.startswith(" ") else text


def decode(encoded: DataFrame, model: Model, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids as column ``name``."""
    schema = T.StructType([f for f in encoded.schema.fields if f.name != name] + [T.StructField(name, T.StringType())])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = pa.array([decode_ids(model, x.as_py()) for x in batch.column(ids)], pa.string())
            names = [f.name for f in schema.fields]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names[:-1]] + [texts], names=names)

    return encoded.mapInArrow(run, schema)
