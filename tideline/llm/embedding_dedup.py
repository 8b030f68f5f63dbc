"""Operator 2, near-duplicate embeddings: cover-tree dual traversal within equal labels.

Equal vectors of a label are one class and are looked at once. The classes of a label are dealt into blocks by the signs of
random projections, so that a block's vectors lie together; too full cells are split. Each block becomes a cover tree, a few
neighbouring blocks a tile. Pairs of tiles that hold blocks whose covering radii don't rule each other out go to one task
each, which traverses the trees against each other and returns, per vector, how many others it links with and one vector of
its component: rows in proportion to the vectors of the tiles, never to the pairs, also where thousands are alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .components import connected_components
from .cover_tree import MARGIN, CoverTree, Groups, dual_traversal, unit

#: Vectors of a block at most, about, and the components of all vectors of a tile together.
BLOCK, TILE_CELLS = 2048, 2**20
BITS = 20
#: Parts into which the rows of one vector are dealt where rows meet by vector.
SALTS = 32


def _cells(dims: int) -> np.ndarray:
    return np.random.default_rng(20240229 + dims).standard_normal((BITS, dims))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dims, v): vectors that can link. Of rows with one vec_id the smallest (label, vector) stands."""
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    v = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("v"))
    rows = rows.where("vec_id is not null and label is not null and size(v) > 0").where(~bad & F.exists("v", lambda x: x != 0))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("vec_id", "r.label", F.size("r.v").alias("dims"), "r.v")


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (vec_id, v1, v2, salt), v1 and v2 the vector's digest: (vec_id, weight) of the smallest vec_id of each vector,
    weight the vectors equal to it; and (v1, v2, salt, rep, weight), so that rows of one vector needn't meet in one task."""
    parts = saved(rows.groupBy("v1", "v2", "salt").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "parts")
    whole = saved(parts.groupBy("v1", "v2").agg(F.min("rep").alias("rep"), F.sum("weight").alias("weight")), "classes")
    return whole.select(F.col("rep").alias("vec_id"), "weight"), parts.select("v1", "v2", "salt").join(whole, ["v1", "v2"])


def _blocks(rows: DataFrame) -> DataFrame:
    """(label, dims, block, tile, centre, radius, tree...) of vectors (vec_id, label, dims, v, weight); saved."""

    @F.pandas_udf("long")
    def code(vs):
        import pandas as pd

        out = []
        planes: dict[int, np.ndarray] = {}
        for v in vs:
            p = planes.setdefault(len(v), _cells(len(v)))
            out.append(int("".join("1" if x > 0 else "0" for x in p @ unit(np.asarray(v, dtype=np.float64)[None])[0]), 2))
        return pd.Series(out, dtype="int64")

    coded = saved(rows.withColumn("code", code("v")), "coded")
    groups = coded.groupBy("label", "dims").agg(F.count("*").alias("n"))
    bits = F.least(F.lit(BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / (BLOCK / 2)))))
    placed = coded.join(groups, ["label", "dims"]).withColumn("cell", F.floor(F.col("code") / F.pow(F.lit(2.0), F.lit(BITS) - bits)).cast("long")).drop("n", "code")
    full = placed.groupBy("label", "dims", "cell").agg(F.count("*").alias("m"))
    placed = placed.join(full, ["label", "dims", "cell"])
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("m") / BLOCK))).drop("m")

    def build(key, table):
        import pyarrow as pa

        label, dims, cell, sub = (k.as_py() for k in key)
        raw = table["v"].combine_chunks().flatten().to_numpy().reshape(-1, dims)
        tree = CoverTree.build(unit(raw))
        ids, weights = table["vec_id"].to_numpy()[tree.order], table["weight"].to_numpy()[tree.order]
        return pa.table({
            "label": pa.array([label]), "dims": pa.array([dims], pa.int32()), "cell": pa.array([cell], pa.int64()), "sub": pa.array([sub], pa.int64()), "centre": pa.array([tree.points[0].tolist()], pa.list_(pa.float64())),
            "radius": pa.array([float(tree.radii[0])]), "ids": pa.array([ids.tobytes()], pa.binary()), "weights": pa.array([weights.tobytes()], pa.binary()), "points": pa.array([raw[tree.order].tobytes()], pa.binary()),
            "nodes": pa.array([tree.nodes.tobytes()], pa.binary()), "radii": pa.array([tree.radii.tobytes()], pa.binary()),
        })

    schema = "label string, dims int, cell long, sub long, centre array<double>, radius double, ids binary, weights binary, points binary, nodes binary, radii binary"
    trees = saved(placed.groupBy("label", "dims", "cell", "sub").applyInArrow(build, schema), "trees")
    # One row for each block here, without its tree.
    number = F.row_number().over(Window.partitionBy("label", "dims").orderBy("cell", "sub")) - 1
    in_tile = F.greatest(F.lit(1), F.floor(F.lit(TILE_CELLS) / (F.col("dims") * BLOCK)))
    tiles = trees.select("label", "dims", "cell", "sub").select("*", number.alias("block")).withColumn("tile", F.floor(F.col("block") / in_tile).cast("long"))
    return saved(trees.join(tiles, ["label", "dims", "cell", "sub"]).drop("cell", "sub"), "blocks")


def _read(row: dict, dims: int, prefix: str) -> tuple[CoverTree, np.ndarray, np.ndarray]:
    ids, weights = (np.frombuffer(row[prefix + c], dtype=np.int64) for c in ("ids", "weights"))
    raw = row[prefix + "points"]
    points = np.frombuffer(raw, dtype=np.float32 if len(raw) == 4 * dims * len(ids) else np.float64).reshape(len(ids), dims)
    return CoverTree(unit(points), None, np.frombuffer(row[prefix + "nodes"], dtype=np.int32).reshape(-1, 4), np.frombuffer(row[prefix + "radii"])), ids, weights


def _traversed(left: list[dict], right: list[dict], cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The blocks of one tile against those of another, or (right is empty) against themselves: of the vectors with links the
    vec_id, the weight of what they link with, and a vec_id of their component."""
    dims = left[0]["dims"]
    one, two = [_read(x, dims, "") for x in left], [_read(x, dims, "r_") for x in right]
    trees = one + two
    at = np.cumsum([0, *[len(t[1]) for t in trees]])
    weight, groups = np.zeros(at[-1], dtype=np.int64), Groups(int(at[-1]))
    for i, (a, _, wa) in enumerate(one):
        for j in range(len(one), len(trees)) if two else range(i, len(one)):
            b, _, wb = trees[j]
            found = dual_traversal(a, b, cosine, wa, wb)
            places = np.arange(at[i], at[i + 1]) if i == j else np.concatenate([np.arange(at[i], at[i + 1]), np.arange(at[j], at[j + 1])])
            weight[places] += found.weight
            groups.link(places, places[found.label])
    ids = np.concatenate([t[1] for t in trees])
    hit = weight > 0
    return ids[hit], weight[hit], ids[groups.label][hit]


def link_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Links vectors of one label (not null) and one length with cosine (double precision) at or over the threshold.
    Vectors that are null, empty, zero or hold null or non-finite components, and null vec_ids, link with nothing.
    Rows that share a vec_id are one vector (the smallest by label and components). Other columns play no part; an
    empty table gives an empty table.
    """
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("salt")
    digest = F.xxhash64("label", "v").alias("v1"), F.xxhash64(F.lit("second"), "label", "v").alias("v2")
    rows = saved(usable(vectors).select("*", *digest, salt), "vectors")
    reps, parts = _classes(rows)
    blocks = _blocks(rows.select("vec_id", "label", "dims", "v").join(reps, "vec_id"))
    meta = blocks.select("label", "dims", "tile", "centre", "radius")
    left = meta.select("label", "dims", F.col("tile").alias("a"), F.col("centre").alias("ca"), F.col("radius").alias("ra"))
    right = meta.select("label", "dims", F.col("tile").alias("b"), F.col("centre").alias("cb"), F.col("radius").alias("rb"))
    apart = F.sqrt(F.aggregate(F.zip_with("ca", "cb", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    limit = float(np.sqrt(2 - 2 * cosine)) + MARGIN
    pairs = left.join(right, ["label", "dims"]).where("a <= b").where(apart - F.col("ra") - F.col("rb") <= limit).select("label", "dims", "a", "b").distinct()
    pairs = saved(pairs, "pairs")
    body = ("ids", "weights", "points", "nodes", "radii")
    one = pairs.join(blocks.select("label", "dims", F.col("tile").alias("a"), *body), ["label", "dims", "a"])
    two = pairs.where("a < b").join(blocks.select("label", "dims", F.col("tile").alias("b"), *[F.col(c).alias(f"r_{c}") for c in body]), ["label", "dims", "b"])
    two = two.select(F.col("label").alias("r_label"), F.col("dims").alias("r_dims"), F.col("a").alias("r_a"), F.col("b").alias("r_b"), *[f"r_{c}" for c in body])

    def traverse(left, right):
        import pyarrow as pa

        return pa.table(dict(zip(("vec_id", "n", "near"), map(pa.array, _traversed(left.to_pylist(), right.to_pylist(), cosine)))))

    found = one.groupBy("label", "dims", "a", "b").cogroup(two.groupBy("r_label", "r_dims", "r_a", "r_b")).applyInArrow(traverse, "vec_id long, n long, near long")
    found = saved(found, "found")
    counts = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("n").alias("n"))
    groups = connected_components(found.select(F.col("vec_id").alias("a"), F.col("near").alias("b"))).withColumnRenamed("node", "rep")
    of_class = parts.join(counts, "rep", "left").join(groups, "rep", "left")
    of_class = of_class.select("v1", "v2", "salt", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    of_vector = rows.select("vec_id", "v1", "v2", "salt").join(of_class, ["v1", "v2", "salt"]).select("vec_id", "n_links", "c")
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(of_vector, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
