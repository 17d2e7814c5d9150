"""Merkle manifest of a dataset: an append log of hash trees in postorder.

The rows of each source are the leaves of a tree of runs of 16, and the subroots of the
sources are the leaves of one more such tree. An aligned builder takes 256 consecutive
nodes of a level, which make a whole subtree two levels high, and appends each node as
soon as it is complete: that is postorder. Where a node stands in that log follows from
the sizes of the subtrees before it, so the siblings of a proof are addressed without any
pointer. The builders of one round run beside each other, and the nodes they end with
are the leaves of the next round; the driver sees counts and the root only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.text import UPPER, ascii_lower
from pagetrail.sources.scratch import scratch_table

FANOUT = 16
LEVELS = 2  # of a builder
SEGMENT = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_FOLD = 5

ANSWERS = ("leaf", "subroot", "proof_sha256", "folded_root")
# Siblings on one level: those before and those after, each as one text.
STEP = T.StructType([T.StructField(n, T.StringType()) for n in ("before", "after")])


def node_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves: runs are hashed while there is more than one node."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // FANOUT)
        levels += 1
    return levels


def position(level: int, index: int, leaves: int) -> int:
    """Where node ``index`` of ``level`` stands in the postorder log of a tree, from 0.

    Its last leaf is number e. Before it stand, on every level, the nodes that end before
    e: e // 16^level of them; and its own descendants that end with e, one on each level.
    """
    width = FANOUT**level
    last = min((index + 1) * width, leaves) - 1
    before, span = level, 1
    while last >= span:
        before += last // span
        span *= FANOUT
    return before


def append_nodes(leaves: list[str], levels: int) -> list[str]:
    """The log of one builder: the leaves and the ``levels`` above, as they are completed."""
    log, open_runs = [], [[] for _ in range(levels + 1)]

    def complete(level: int, node: str) -> None:
        log.append(node)
        open_runs[level].append(node)
        if level < levels and len(open_runs[level]) == FANOUT:
            run, open_runs[level] = open_runs[level], []
            complete(level + 1, node_hash("".join(run)))

    for leaf in leaves:
        complete(0, leaf)
    for level in range(levels):  # what the last leaves leave open
        if open_runs[level]:
            run, open_runs[level] = open_runs[level], []
            complete(level + 1, node_hash("".join(run)))
    return log


def siblings(log: list[str], leaves: int, levels: int, index: int) -> list[tuple[str, str]]:
    """Of leaf ``index`` the siblings on each level, before and after the node."""
    steps, size = [], leaves
    for level in range(levels):
        first = index - index % FANOUT
        run = range(first, min(first + FANOUT, size))
        before = [log[position(level, i, leaves)] for i in run if i < index]
        after = [log[position(level, i, leaves)] for i in run if i > index]
        steps.append(("".join(before), "".join(after)))
        index, size = index // FANOUT, -(-size // FANOUT)
    return steps


def fold_root(leaf: str, steps: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in steps:
        leaf = node_hash(before + leaf + after)
    return leaf


def _levels(leaves: int, round_no: int) -> int:
    """Levels that a builder of this round adds in a tree of so many leaves."""
    return min(LEVELS, max(0, height(leaves) - round_no * LEVELS))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_hash(values: list[Column]) -> Column:
    """H of the values in turn: a dash for null, else the length in bytes, a colon, the value."""
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def _tree(source: Column) -> Column:
    """Sorts like the source, null first, and is never null itself."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """The rows with their ``index`` within ``tree``, in ``order``, and the tree's ``n``.

    Rows are sorted over all partitions and numbered by partition, tree and place, so
    a tree with most of the rows is spread like any other. The sorted rows are written, as
    their numbers must not change when a task is run again. Equal rows share no place.
    """
    by = ["tree", *order, F.monotonically_increasing_id()]
    placed = leaves.repartitionByRange(*by).sortWithinPartitions("tree", *order)
    placed = placed.withColumns(
        {"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}
    )
    placed = scratch_table(placed, "sorted-leaves")
    parts = placed.groupBy("tree", "_part").agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    # A row per partition and tree: each tree has as many as partitions it reaches into.
    before = Window.partitionBy("tree").orderBy("_part")
    parts = parts.withColumns(
        {
            "_start": F.sum("_rows").over(before) - F.col("_rows"),
            "n": F.sum("_rows").over(Window.partitionBy("tree")),
        }
    )
    numbered = placed.join(parts.drop("_rows"), ["tree", "_part"])
    index = F.col("_start") + F.col("_place") - F.col("_first")
    return numbered.withColumn("index", index).drop("_part", "_place", "_start", "_first")


def _built(members: DataFrame, round_no: int) -> DataFrame:
    """A row per builder: ``tree``, ``segment``, ``n``, ``members`` and ``log``.

    ``members`` has ``tree``, ``n``, ``index`` and ``leaf``; of a segment at most 256
    meet, whatever the size of the tree.
    """
    payload = [c for c in members.columns if c not in ("tree", "n", "index")]
    grouped = members.groupBy(
        "tree", F.floor(F.col("index") / F.lit(SEGMENT)).cast("long").alias("segment")
    ).agg(
        F.first("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("index", *payload))).alias("members"),
    )
    grouped = grouped.select("*", F.col("members.leaf").alias("leaves"))
    added = T.StructField("log", T.ArrayType(T.StringType()))
    schema = T.StructType([*grouped.schema.fields, added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, sizes = batch.column("leaves"), batch.column("n").to_pylist()
            for at, n in enumerate(sizes):
                log = append_nodes(leaves[at].as_py(), _levels(n, round_no))
                one = batch.slice(at, 1)
                yield pa.RecordBatch.from_arrays(
                    [*one.columns, pa.array([log], pa.list_(pa.string()))], schema.names
                )

    return scratch_table(grouped.mapInArrow(run, schema).drop("leaves"), "segments")


def append_log(members: DataFrame) -> list[DataFrame]:
    """The builders of each round, until every tree has one node left.

    ``members`` as for ``ranked``'s result. The rounds follow from the largest tree, the
    logarithm of its leaves to the base of 256. Trees that are complete take no further part.
    """
    rounds = [_built(members, 0)]
    most = rounds[0].agg(F.max("n")).first()[0] or 0
    while most > SEGMENT ** len(rounds):
        done = SEGMENT ** len(rounds)
        ended = rounds[-1].filter(F.col("n") > done).select(
            "tree", "n", F.col("segment").alias("index"), F.element_at("log", -1).alias("leaf")
        )
        rounds.append(_built(ended, len(rounds)))
    return rounds


def subroots(rounds: list[DataFrame]) -> DataFrame:
    """``tree`` and the ``node`` it ends with: the last that its last builder appended."""
    found = None
    for round_no, segments in enumerate(rounds):
        complete = segments.filter(F.col("n") <= SEGMENT ** (round_no + 1)).select(
            "tree", F.element_at("log", -1).alias("node")
        )
        found = complete if found is None else found.unionByName(complete)
    return found


def _climbed(segments: DataFrame, above: DataFrame, round_no: int) -> DataFrame:
    """``above`` for the round below: its builders are this round's members."""
    carried = [f for f in above.schema.fields if f.name not in ("tree", "segment", "steps")]
    names = [f.name for f in carried]
    joined = segments.join(above, ["tree", "segment"]).select(
        "tree", "segment", "n", "log", "steps", *names
    )
    schema = T.StructType(
        [
            T.StructField("tree", T.StringType()),
            T.StructField("segment", T.LongType()),
            T.StructField("steps", T.ArrayType(STEP)),
            *carried,
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                first = row["segment"] * SEGMENT
                size = -(-row["n"] // SEGMENT**round_no)
                count = min(SEGMENT, size - first)
                levels = _levels(row["n"], round_no)
                upper = [(s["before"], s["after"]) for s in row["steps"]]
                steps = [siblings(row["log"], count, levels, i) + upper for i in range(count)]
                arrays = [
                    pa.array([row["tree"]] * count, pa.string()),
                    pa.array(range(first, first + count), pa.int64()),
                    pa.array(
                        [[dict(zip(STEP.names, s, strict=True)) for s in x] for x in steps],
                        pa.list_(pa.struct([(n, pa.string()) for n in STEP.names])),
                    ),
                    *[pa.array([row[c]] * count, batch.schema.field(c).type) for c in names],
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return joined.mapInArrow(run, schema)


def steps_above(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``tree``, ``segment`` and ``steps`` for the builders of the first round.

    ``tops`` has a row per tree with the steps above its root, and columns to carry along.
    """
    found = None
    for round_no in reversed(range(len(rounds))):
        alone = F.col("n") <= SEGMENT ** (round_no + 1)  # trees this round's builder ends
        if round_no:
            alone &= F.col("n") > SEGMENT**round_no
        ends = rounds[round_no].filter(alone).select("tree", "segment").join(tops, "tree")
        found = ends if found is None else found.unionByName(ends)
        if round_no:
            found = _climbed(rounds[round_no], found, round_no)
    return found


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", tree: str = "source"
) -> DataFrame:
    """A row per document: ``key``, its ``index`` within its tree of ``n`` leaves, ``tree``,
    ``leaf`` and ``changed``, the leaf of the tampered row where the row is tampered with.

    Rows with the same tree and key are ordered by their leaves; rows without a key come
    first. Nulls are told apart from empty texts by the hashed form. Tampering lower-cases
    the letters A-Z of ``text`` where 5 divides the crc32 of the key as text.
    """
    values = [F.col(f) for f in fields]
    lowered = [ascii_lower(F.col(f)) if f == "text" else F.col(f) for f in fields]
    tampered = F.crc32(F.col(key).cast("string").cast("binary")) % TAMPERED_FOLD == 0
    has_capitals = F.col("text").rlike(f"[{UPPER}]")
    leaves = docs.select(
        _tree(F.col(tree)).alias("tree"),
        F.col(key).alias("key"),
        leaf_hash(values).alias("leaf"),
        F.when(tampered & has_capitals, leaf_hash(lowered)).alias("changed"),
    )
    return ranked(leaves, ["key", "leaf"])


def log_rows(rounds: list[DataFrame]) -> DataFrame:
    """The log as rows: ``tree``, ``level``, ``index``, ``position``, ``node``, addressed in
    the whole tree. A builder's leaves that the round before has appended are left out."""
    parts = []
    for round_no, segments in enumerate(rounds):
        fields = "tree string, level int, index long, position long, node string"

        def run(
            batches: Iterator[pa.RecordBatch], round_no: int = round_no
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    first, n = row["segment"] * SEGMENT, row["n"]
                    count = min(SEGMENT, -(-n // SEGMENT**round_no) - first)
                    out = []
                    for level in range(1 if round_no else 0, _levels(n, round_no) + 1):
                        width = FANOUT**level
                        whole = round_no * LEVELS + level
                        for i in range(-(-count // width)):
                            index = first // width + i
                            node = row["log"][position(level, i, count)]
                            out.append((row["tree"], whole, index, position(whole, index, n), node))
                    kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
                    columns = zip(*out, strict=True) if out else [[]] * len(kinds)
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        arrays, ["tree", "level", "index", "position", "node"]
                    )

        parts.append(segments.select("tree", "segment", "n", "log").mapInArrow(run, fields))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _proved(segments: DataFrame, above: DataFrame, key: T.StructField) -> DataFrame:
    """For each member its proof's hash and the root that it, or its tampered form, leads to."""
    joined = segments.join(above, ["tree", "segment"])
    joined = joined.select("members", "n", "log", "steps", "subroot")
    kinds = [T.StructField(c, T.StringType()) for c in ANSWERS]
    schema = T.StructType([T.StructField("key", key.dataType), *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                members = one.column("members").flatten()
                leaves, changed, indexes = (
                    members.field(c).to_pylist() for c in ("leaf", "changed", "index")
                )
                log, upper = one.column("log")[0].as_py(), one.column("steps")[0].as_py()
                upper = [(s["before"], s["after"]) for s in upper]
                tail = "".join(before + after for before, after in upper)
                levels = _levels(one.column("n")[0].as_py(), 0)
                proofs, roots = [], []
                for leaf, other, index in zip(leaves, changed, indexes, strict=True):
                    steps = siblings(log, len(leaves), levels, index % SEGMENT)
                    own = "".join(before + after for before, after in steps)
                    proofs.append(node_hash(own + tail))
                    roots.append(fold_root(leaf if other is None else other, steps + upper))
                subroot = pa.array([one.column("subroot")[0].as_py()] * len(leaves), pa.string())
                arrays = [members.field("key"), members.field("leaf"), subroot]
                arrays += [pa.array(x, pa.string()) for x in (proofs, roots)]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return joined.mapInArrow(run, schema)


def proofs(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", tree: str = "source"
) -> DataFrame:
    """``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A row for every document. ``verified`` tells whether the siblings lead from the leaf,
    or from that of the tampered row, to the root. Rows without a key, source, language or
    text are leaves like any other; repeated rows have a leaf each. An empty table has no
    root and gives no rows. Other columns of the input are not looked at.
    """
    members = manifest(docs, fields, key, tree)
    rounds = append_log(members)
    sources = subroots(rounds).select(
        F.lit("").alias("tree"), F.col("tree").alias("source_tree"), F.col("node").alias("leaf")
    )
    top = append_log(ranked(sources, ["source_tree"]))
    found = subroots(top).first()
    root = found.node if found else None
    no_steps = F.array().cast(T.ArrayType(STEP)).alias("steps")
    one = docs.sparkSession.range(1, numPartitions=1).select(F.lit("").alias("tree"), no_steps)
    above = steps_above(top, one)
    tops = _source_steps(top[0], above)
    placed = steps_above(rounds, tops)
    judged = _proved(rounds[0], placed, docs.schema[key])
    return judged.select(
        F.col("key").alias(key),
        "leaf",
        "subroot",
        F.lit(root).cast("string").alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )


def _source_steps(segments: DataFrame, above: DataFrame) -> DataFrame:
    """For each source's tree its subroot and the steps from there to the root."""
    joined = segments.join(above, ["tree", "segment"]).select("members", "n", "log", "steps")
    schema = T.StructType(
        [
            T.StructField("tree", T.StringType()),
            T.StructField("subroot", T.StringType()),
            T.StructField("steps", T.ArrayType(STEP)),
        ]
    )
    step = pa.list_(pa.struct([(n, pa.string()) for n in STEP.names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                members, levels = row["members"], _levels(row["n"], 0)
                steps = [
                    [
                        dict(zip(STEP.names, s, strict=True))
                        for s in siblings(row["log"], len(members), levels, m["index"] % SEGMENT)
                    ]
                    + row["steps"]
                    for m in members
                ]
                arrays = [
                    pa.array([m["source_tree"] for m in members], pa.string()),
                    pa.array([m["leaf"] for m in members], pa.string()),
                    pa.array(steps, step),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return joined.mapInArrow(run, schema)
