"""Operator 8: links between near-equal embeddings, by iterative quantisation and multi-index Hamming tables.

1. Vectors of equal label and equal components are one from here on, with the number of its copies.
2. A rotation of the principal axes is learned on a bounded sample so that the signs of the rotated components lose as
   little as may be (iterative quantisation). The signs are the code, cut into ``CHUNKS`` chunks.
3. Every pair of chunks is a table; vectors meet in a cell if both chunks agree. With codes of 64 bits, vectors of cosine 0.98 differ in
   about four bits, and two of eight chunks agree with a chance of 0.99; closer vectors nearly always meet.
4. In a cell the original vectors decide, in double precision. A pair is counted in the first table in which it meets, so
   every link counts once. Cells beyond ``BLOCK`` vectors are dealt into blocks, and each pair of blocks is a task; what
   leaves a cell is a count and a class for each vector, never the pairs.

A null label, a null or empty vector, null or non-finite components and a zero vector link with nothing: no links, own component.
Vectors of different length link with nothing. Rows that share an id are one vector with several places: its links are the sum.
A null id is kept, with a null component.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components, groups
from millrace.llm.texts import checkpointed, map_parts

COSINE = 0.98
SAMPLE = 20_000
BITS, CHUNKS, ROUNDS = 64, 8, 40
BLOCK = 1_500


def learn_rotation(rows: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimensions by bits) whose signs are balanced codes."""
    mean = rows.mean(axis=0)
    size = min(bits, rows.shape[1])
    _, axes = np.linalg.eigh(np.cov((rows - mean).T).reshape(rows.shape[1], rows.shape[1]) if len(rows) > 1 else np.eye(rows.shape[1]))
    axes = axes[:, ::-1][:, :size]
    projected = (rows - mean) @ axes
    rotation = np.linalg.qr(np.random.Generator(np.random.PCG64(8)).normal(size=(size, size)))[0]
    for _ in range(rounds):
        codes = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ projected)
        rotation = right.T @ left.T
    return mean, axes @ rotation


def chunk_codes(rows: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Chunks of the code of each unit vector, as small numbers."""
    signs = ((rows - mean) @ projection >= 0).astype(np.int64)
    pieces = np.array_split(np.arange(signs.shape[1]), min(CHUNKS, signs.shape[1]))
    return np.stack([signs[:, p] @ (1 << np.arange(len(p))) for p in pieces], axis=1)


def tables_of(chunks: int) -> list[tuple[int, int]]:
    return list(combinations(range(chunks), 2)) or [(0, 0)]


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """id, label, dim, vector (doubles as bytes) of the vectors that can link."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where("id is not null and label is not null and size(embedding) > 0")

    def begin():
        def step(ids, labels, lists):
            made: list[list] = [[], [], [], []]
            for i, label, values in zip(ids.to_pylist(), labels.to_pylist(), lists, strict=True):
                row = values.values
                x = np.array(row.to_numpy(zero_copy_only=False), dtype=np.float64)
                top = np.abs(x).max()
                if row.null_count or not np.isfinite(x).all() or top == 0:
                    continue
                x = x / top + 0.0  # cosine knows no length; this keeps squares in range and has one zero
                for column, value in zip(made, (i, label, len(x), x.tobytes()), strict=True):
                    column.append(value)
            return made

        return step

    return map_parts(rows, begin, "id bigint, label string, dim int, vector binary", text=None)


def cell_links(ids: np.ndarray, copies: np.ndarray, x: np.ndarray, chunks: np.ndarray, table: tuple[int, int], cosine: float, side: np.ndarray | None):
    """Links (copies counted) and least linked id of each vector of a cell.

    With ``side``, a mask, only pairs across the two sides are looked at.
    """
    n = len(ids)
    near = x @ x.T >= cosine
    near[np.arange(n), np.arange(n)] = False
    if side is not None:
        near &= side[:, None] != side[None, :]
    i, j = table
    for c in range(j):
        if c != i:  # an earlier pair of chunks that agree: the pair of vectors was counted there
            near &= chunks[:, c][:, None] != chunks[:, c][None, :]
    links = near @ copies
    least = ids.copy()
    while True:
        lower = np.minimum(least, np.where(near, least[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lower == least).all():
            return links, least
        least = lower


def embedding_links(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    spark = vectors.sparkSession
    usable = checkpointed(usable_vectors(vectors))
    distinct = checkpointed(
        usable.groupBy("label", "dim", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("key", F.sha2(F.concat(F.concat_ws(":", F.lit(""), "label", "dim").cast("binary"), "vector"), 256))
    )
    models = {}
    for row in distinct.groupBy("dim").count().collect():
        share = min(1.0, sample / row["count"]) * 1_000_000
        drawn = distinct.where((F.col("dim") == row.dim) & (F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < share)).select("key", "vector").collect()
        known = unit(np.array([np.frombuffer(r.vector) for r in sorted(drawn, key=lambda r: r.key)]).reshape(-1, row.dim)) if drawn else np.eye(row.dim)
        models[row.dim] = learn_rotation(known)
    shared = spark.sparkContext.broadcast(models)

    def begin():
        def step(keys, labels, dims, packed):
            made: list[list] = [[], [], []]
            sizes = dims.to_numpy()
            names, data, by_label = keys.to_pylist(), packed.to_pylist(), labels.to_pylist()
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                codes = chunk_codes(unit(np.array([np.frombuffer(data[k]) for k in at])), *shared.value[int(dim)])
                for k, code in zip(at, codes.tolist(), strict=True):
                    cells = [
                        int.from_bytes(hashlib.blake2b(f"{dim}:{t}:{code[i]}:{code[j]}:{by_label[k]}".encode(), digest_size=8).digest(), "little", signed=True)
                        for t, (i, j) in enumerate(tables_of(len(code)))
                    ]
                    for column, value in zip(made, (names[k], code, cells), strict=True):
                        column.append(value)
            return made

        return step

    coded = checkpointed(
        map_parts(distinct.select("key", "label", "dim", "vector"), begin, "key string, code array<int>, cells array<bigint>", text=None)
    )
    placed = coded.select("key", F.posexplode("cells").alias("table", "cell"))
    full = placed.groupBy("table", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = full.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).drop("n")
    met = placed.join(full, ["table", "cell"]).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    carried = met.join(distinct.drop("label"), "key").join(coded.select("key", "code"), "key")
    tasks = carried.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "table", "cell", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own", "id", "copies", "code", "vector"
    )
    dealt = tasks.repartition("table", "cell", "first", "second").sortWithinPartitions("table", "cell", "first", "second")

    def run(batches):
        for group in groups(batches, 4):
            first, second = group["first"][0].as_py(), group["second"][0].as_py()
            ids, copies, own = (group[c].to_numpy() for c in ("id", "copies", "own"))
            chunks = np.array(group["code"].to_pylist())
            x = unit(np.array([np.frombuffer(v) for v in group["vector"].to_pylist()]))
            table = tables_of(chunks.shape[1])[group["table"][0].as_py()]
            links, least = cell_links(ids, copies, x, chunks, table, cosine, None if first == second else own == first)
            at = np.flatnonzero(links)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at].astype(np.int64)), pa.array(least[at])], names=["id", "links", "least"])

    found = checkpointed(dealt.mapInArrow(run, "id bigint, links bigint, least bigint"))
    classes = connected_components(found.select(F.col("id").alias("u"), F.col("least").alias("v")))
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    # the copies of one vector are linked with each other
    by_vector = distinct.join(totals, "id", "left").join(classes, "id", "left").select(
        "label", "dim", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    by_id = usable.join(by_vector, ["label", "dim", "vector"]).groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component").alias("component"))
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    joined = every.join(by_id, every["vec_id"] == by_id["id"], "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )
