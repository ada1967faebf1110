"""Operator 12, a Merkle manifest of a dataset with pointer-jumping proofs.

Rows are leaves of one tree a group (8 children a node), and the groups'
subroots, ordered by group, are the leaves of a tree above them.  A digest H
is the lowercase hexadecimal SHA-256 of its inputs, joined; a field reads ``-``
if null, else its number of UTF-8 bytes, ``:`` and its value.  While a tree has
more than one node, every ``FAN`` consecutive ones (the last run may be
shorter, even one) become their H.

Nodes are named (tree, level, idx); trees are numbered by the order of their
groups, the tree above is number -1, and a group's subroot is its leaf
(-1, 0, tree).  ``tree_nodes`` builds a level from the one below, so that the
work shrinks by ``FAN`` a level.

Proofs by pointer jumping (``jump``): each inner node points to its parent and
holds the siblings on the way, split into those left and right of it.  A
self-join then replaces a pointer by the pointer of the node that it points to
and joins the two segments, so the distance doubles each round, and after
log2 of the height every node points to the root.  Leaves take the last jump
only: they join the run that they stand in, so the long segments move once a
run and not once a leaf.  In later rounds a node is pointed to by very many;
its row is then copied to salts, one for about ``FAN**2`` pointers each.

Defined results: null fields read ``-``; a null group is a tree of its own and
comes first; rows without an id come first in their tree; rows that repeat an
id are leaves of their own, ordered by their digest; a lone leaf is its tree's
subroot, a lone subroot is the root, and their proof is H of nothing; empty
input gives empty tables.  Only the named columns are read, so others may have
any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, written
from .positions import positions

FAN = 8
TOP = -1  # number of the tree above the groups' trees
NODE = ["tree", "level", "idx"]


def field(c: Column) -> Column:
    """A field as it goes into a leaf; integers are written as decimals."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def _heights(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    bounds = [FAN ** k for k in range(21)]  # as many as a long can number
    return F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b < n))


def leaf_table(rows: DataFrame, group: str, order: str, leaf: str = "leaf") -> tuple[DataFrame, DataFrame]:
    """``rows`` (one a leaf, with its digest in ``leaf``) with ``tree``,
    ``idx`` and the tree's ``height``; and the trees (tree, group, n, height).
    Both are written tables."""
    placed = written(positions(written(rows, "merkle_rows"), [group], [F.col(order), F.col(leaf)], "idx"), "merkle_placed")
    counts = cut(placed.groupBy(group).agg((F.max("idx") + 1).alias("n")))
    trees = written(positions(counts, [], [F.col(group)], "tree")  # null first, then by UTF-8 bytes
                    .select("tree", group, "n", _heights(F.col("n")).alias("height")), "merkle_trees")
    # a group may hold most rows: it is joined by ranges of 65,536 places
    ranges = trees.select(F.col(group).alias("__g"), "tree", "height", F.explode(
        F.expr("sequence(0L, shiftright(n - 1, 16))")).alias("__s"))
    named = placed.join(ranges, F.col(group).eqNullSafe(F.col("__g")) & (F.shiftright("idx", 16) == F.col("__s")))
    return written(named.select(*rows.columns, "tree", "idx", "height"), "merkle_leaves"), trees


def _level(below: DataFrame, level: int) -> DataFrame:
    """The nodes of a level, from (tree, height, idx, digest, reach) of the
    one below: ``kids`` are their children's digests in order, ``reach`` is the
    distance to the furthest inner node below."""
    kid = F.struct("idx", "digest", "reach")
    up = below.groupBy("tree", "height", F.expr(f"idx div {FAN}").alias("up")).agg(
        F.sort_array(F.collect_list(kid)).alias("k"))  # FAN at most
    up = up.select("tree", "height", F.lit(level).cast("long").alias("level"), F.col("up").alias("idx"),
                   F.array_join(F.col("k.digest"), "").alias("joined"), F.col("k.reach").alias("reaches"))
    return up.select("tree", "height", "level", "idx", F.unhex("joined").alias("kids"), "reaches",
                     F.sha2("joined", 256).alias("digest"), (F.array_max("reaches") + 1).alias("reach"))


def tree_nodes(leaves: DataFrame, trees: DataFrame, leaf: str = "leaf") -> DataFrame:
    """(tree, level, idx, kids, reaches, digest, reach, subroot, root): every
    node above the leaves; the last two say what it is."""
    spark = leaves.sparkSession
    top = trees.agg(F.max("height"), F.count(F.lit(1))).first()
    highest, n_trees = top[0] or 0, top[1]
    above = sum(n_trees > FAN ** k for k in range(21))
    level0 = leaves.select("tree", "height", "idx", F.col(leaf).alias("digest"), F.lit(-1).alias("reach"))

    def levels(below, height):
        found = []
        for k in range(1, height + 1):
            found.append(cut(_level(below.where(F.col("height") >= k), k)))
            below = found[-1].where(F.col("height") > k)
        return found

    own = levels(level0, highest)
    ends = [x.where(F.col("level") == F.col("height")) for x in own] + [level0.where("height = 0")]
    subs = None
    for x in ends:
        x = x.select("tree", "digest", "reach")
        subs = x if subs is None else subs.unionByName(x)
    subs = subs.select(F.lit(TOP).cast("long").alias("tree"), F.lit(above).alias("height"), F.col("tree").alias("idx"), "digest", "reach")
    both = [*own, *levels(cut(subs), above)]
    if not both:
        both = [_level(level0.limit(0), 1)]
    sub = (F.col("tree") != TOP) & (F.col("level") == F.col("height"))
    parts = [x.withColumn("subroot", sub).withColumn(
        "root", (F.col("subroot") & F.lit(above == 0)) | ((F.col("tree") == TOP) & (F.col("level") == above))) for x in both]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    named = out.select(F.when(F.col("subroot"), TOP).otherwise(F.col("tree")).alias("tree"),
                       F.when(F.col("subroot"), 0).otherwise(F.col("level")).alias("level"),
                       F.when(F.col("subroot"), F.col("tree")).otherwise(F.col("idx")).alias("idx"),
                       F.col("level").alias("height"), "kids", "reaches", "digest", "reach", "subroot", "root")
    return written(named, "merkle_nodes")


def _beside(kids: Column, j: Column) -> Column:
    """The siblings of child j: the digests left and right of it."""
    return F.struct(F.substring(kids, F.lit(1), 32 * j).alias("left"),
                    F.substring(kids, 32 * j + 33, F.octet_length(kids)).alias("right"))


def jump(nodes: DataFrame) -> DataFrame:
    """(tree, level, idx, path, sub, root) of every inner node but the root:
    the siblings on its way to the root, lowest first, the digest of its
    tree's subroot (null above the subroots), and the root's."""
    inner = nodes.where((F.col("tree") == TOP) & (F.col("level") > 0) | (F.col("height") > 1))
    kids = inner.select("*", F.posexplode("reaches").alias("j", "kid_reach"))
    at = cut(kids.select(
        F.when(F.col("subroot"), F.col("idx")).otherwise(F.col("tree")).alias("tree"), (F.col("height") - 1).alias("level"),
        (F.when(F.col("subroot"), 0).otherwise(F.col("idx")) * FAN + F.col("j")).alias("idx"),
        F.struct(*NODE).alias("to"), F.array(_beside(F.col("kids"), F.col("j"))).alias("path"),
        F.when(F.col("subroot"), F.col("digest")).when((F.col("tree") == TOP) & (F.col("level") == 1), F.lower(F.hex(
            F.substring("kids", 32 * F.col("j") + 1, F.lit(32))))).alias("sub"),
        F.when(F.col("root"), F.col("digest")).alias("root"), F.col("kid_reach").alias("reach")))
    distance = 1
    while True:
        open_ = at.where("root is null")
        if open_.isEmpty():
            return at.select(*NODE, "path", "sub", "root")
        salts = FAN ** max(0, distance - 2)
        next_ = at.where(F.col("reach") >= distance).select(
            F.struct(*NODE).alias("to"), F.col("to").alias("further"), F.col("path").alias("more"),
            F.col("sub").alias("sub2"), F.col("root").alias("root2"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
        dealt = open_.withColumn("salt", F.pmod(F.xxhash64("tree", F.expr(f"idx div {FAN * FAN}")), F.lit(salts)))
        moved = dealt.join(next_, ["to", "salt"]).select(
            *NODE, F.col("further").alias("to"), F.concat("path", "more").alias("path"),
            F.coalesce("sub", "sub2").alias("sub"), F.col("root2").alias("root"), "reach")
        at = cut(moved.unionByName(at.where("root is not null")))
        distance *= 2


def proofs(leaves: DataFrame, trees: DataFrame, leaf: str = "leaf") -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path``, an array of the
    siblings (left, right; binary digests) of each level, lowest first."""
    nodes = tree_nodes(leaves, trees, leaf)
    ends = jump(nodes).withColumnRenamed("root", "__end")
    runs = nodes.where(F.col("height") == 1).join(ends, NODE, "left").select(
        F.struct(*NODE).alias("__run"), F.col("kids").alias("__kids"), F.col("path").alias("__path"),
        F.when(F.col("subroot"), F.col("digest")).otherwise(F.col("sub")).alias("__sub"),
        F.when(F.col("root"), F.col("digest")).otherwise(F.col("__end")).alias("__root"))
    lone, low = F.col("height") == 0, F.col("height") == 1
    number = lambda c: c.cast("long")
    run = F.struct(F.when(lone | low, TOP).otherwise(F.col("tree")).cast("long").alias("tree"),
                   number(F.when(low, 0).otherwise(1)).alias("level"),
                   F.when(lone, F.expr(f"tree div {FAN}")).when(low, F.col("tree")).otherwise(F.expr(f"idx div {FAN}")).alias("idx"))
    j = F.pmod(F.when(lone, F.col("tree")).otherwise(F.col("idx")), F.lit(FAN)).cast("int")
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    both = leaves.withColumn("__run", run).withColumn("__j", j).join(runs, "__run", "left")
    path = F.when(F.col("__kids").isNull(), none).otherwise(F.concat(
        F.array(_beside(F.col("__kids"), F.col("__j"))), F.coalesce("__path", none)))
    return both.select(*leaves.columns, F.when(lone, F.col(leaf)).otherwise(F.col("__sub")).alias("subroot"),
                       F.coalesce("__root", leaf).alias("root"), path.alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its proof give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])), 256))


def path_digest(path: Column) -> Column:
    """H of the siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: _hex(F.concat(s["left"], s["right"]))), ""), 256)


def document_leaf(docs: DataFrame, text: Column) -> Column:
    """The digest of a document with ``text`` in place of its own."""
    return digest(field(docs["doc_id"]), field(docs["source"]), field(docs["lang"]), field(docs["n_chars"]), field(text))


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` by language with every document's proof, and
    the proofs' check against a copy of the documents in which the text's A-Z
    are lower-case wherever 3 divides crc32(doc_id)."""
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select("doc_id", "lang", document_leaf(docs, F.col("text")).alias("leaf"),
                       F.when(touched, document_leaf(docs, low)).alias("other"))
    found = proofs(*leaf_table(rows, "lang", "doc_id"))
    folded = fold(F.coalesce("other", "leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
