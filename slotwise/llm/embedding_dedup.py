"""Near-duplicate embeddings: int8 tile products with error bounds, then full precision.

Vectors are compared only within a label. Equal vectors are one class, so that copies cost
nothing. The classes of a label are dealt into tiles of bounded size, and every pair of its
tiles is one group of rows. In it the int8 forms of the unit vectors are multiplied, which
float32 does exactly, and a pair whose product can reach the threshold within the errors of
its two vectors is computed again from the vectors in double precision.

A pair of tiles yields no pairs but sums: per class the number of its partners, and a
spanning forest of the links. A dense group of near copies so gives as many rows as it has
members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slotwise.llm.common import written
from slotwise.llm.components import components
from slotwise.llm.simhash_dedup import _forest

LEAST = 0.93
# Numbers in a tile: 4,096 vectors of 64 dimensions.
CELLS = 1 << 18
# Rows of a tile that are multiplied at once, and pairs that are computed again at once.
BLOCK, PAIRS = 512, 1 << 15
# Products of int8 values over so many dimensions are whole numbers below 2^24.
EXACT_DIMENSIONS = 1024
# What the float32 scaling of a product and the double sums of a bound may be off by.
SLACK = 1e-5


def usable(embedding: Column) -> Column:
    """Whether a vector has a direction: finite entries, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows divided by their length, in double precision; the largest entry first, so that
    neither very large nor very small ones leave the range."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scales, errors): a unit vector is at most its error away from scale times row."""
    scales = np.abs(units).max(axis=1) / 127
    rows = np.rint(units / scales[:, None]).astype(np.int8)
    rest = units - rows * scales[:, None]
    return rows, scales, np.sqrt(np.einsum("ij,ij->i", rest, rest)) * (1 + 1e-9) + 1e-12


def upper_bounds(a: tuple, b: tuple) -> np.ndarray:
    """For all pairs of rows of two quantised sets a value that their cosine does not exceed,
    but for SLACK.

    With u = p + du and v = q + dv the product u.v is p.q + p.dv + du.v, where v has length
    one and p at most 1 + |du|.
    """
    rows, scales, errors = a
    others, other_scales, other_errors = b
    product = None
    for at in range(0, rows.shape[1], EXACT_DIMENSIONS):
        cut = slice(at, at + EXACT_DIMENSIONS)
        part = rows[:, cut].astype(np.float32) @ others[:, cut].astype(np.float32).T
        product = part if product is None else product.astype(np.float64) + part
    product *= scales.astype(product.dtype)[:, None]
    product *= other_scales.astype(product.dtype)
    product += errors.astype(product.dtype)[:, None]
    product += ((1 + errors.max()) * other_errors).astype(product.dtype)
    return product


def _cosines(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Double-precision cosines of the pairs (i, j) of unit rows."""
    if 4 * len(i) > len(a) * len(b):
        return (a @ b.T)[i, j]
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        cut = slice(at, at + PAIRS)
        out[cut] = np.einsum("ij,ij->i", a[i[cut]], b[j[cut]])
    return out


def _tile_pair(units, forms, copies, first: np.ndarray, second: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(partners, root) of all rows, from the pairs of a row of ``first`` and one of ``second``;
    the two are the same rows, or have none in common."""
    same = first is second
    partners, root = np.zeros(len(units), np.int64), np.arange(len(units))
    for at in range(0, len(first), BLOCK):
        left = first[at : at + BLOCK]
        right = second[at:] if same else second
        bounds = upper_bounds(tuple(x[left] for x in forms), tuple(x[right] for x in forms))
        i, j = np.nonzero(bounds >= least - SLACK)
        if same:
            i, j = i[i < j], j[i < j]
        near = _cosines(units[left], units[right], i, j) >= least
        i, j = left[i[near]], right[j[near]]
        np.add.at(partners, i, copies[j])
        np.add.at(partners, j, copies[i])
        moved = np.flatnonzero(root != np.arange(len(root)))
        node, to = _forest(len(root), np.concatenate([moved, i]), np.concatenate([root[moved], j]))
        root[node] = to
    return partners, root


def classes(vectors: DataFrame) -> DataFrame:
    """Written rows, one for each label and distinct usable vector: node, label, size,
    embedding, copies, least_id and the quantised form (form, scale, error)."""
    kind = dict(vectors.dtypes)["embedding"]
    label = dict(vectors.dtypes)["label"]
    alike = vectors.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    alike = alike.select(F.monotonically_increasing_id().alias("node"), "label", F.size("embedding").alias("size"), "embedding", "copies", "least_id")

    def run(batches):
        for batch in batches:
            forms, scales, errors = [], np.empty(batch.num_rows), np.empty(batch.num_rows)
            lists = batch.column("embedding")
            for k in range(batch.num_rows):
                row, scales[k : k + 1], errors[k : k + 1] = quantised(unit(lists[k].values.to_numpy().astype(np.float64)[None, :]))
                forms.append(row.tobytes())
            for name, column in (("form", pa.array(forms, pa.binary())), ("scale", pa.array(scales)), ("error", pa.array(errors))):
                batch = batch.append_column(name, column)
            yield batch

    schema = f"node long, label {label}, size int, embedding {kind}, copies long, least_id long, form binary, scale double, error double"
    return written(alike.mapInArrow(run, schema), "vector-classes")


def _links(alike: DataFrame, least: float, cells: int) -> DataFrame:
    """Rows (node, partners, root) from all pairs of tiles; see ``_tile_pair``."""
    group = ["label", "size"]
    counts = written(alike.groupBy(*group).agg(F.count(F.lit(1)).alias("members")), "vector-counts")
    tiles = F.ceil(F.col("members") * F.col("size") / F.lit(cells)).cast("int")
    dealt = alike.join(counts, group).withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    dealt = dealt.select(*group, "node", "embedding", "copies", "form", "scale", "error", "tile", other)
    dealt = dealt.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")).drop("other")

    def run(tab: pa.Table) -> pa.Table:
        nodes = tab.column("node").to_numpy()
        order = np.argsort(nodes)
        tab, nodes = tab.take(order), nodes[order]
        units = unit(tab.column("embedding").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(nodes), -1))
        forms = np.frombuffer(b"".join(tab.column("form").to_pylist()), np.int8).reshape(len(nodes), -1)
        forms = (forms, tab.column("scale").to_numpy(), tab.column("error").to_numpy())
        tile = tab.column("tile").to_numpy()
        first = np.flatnonzero(tile == tab.column("low")[0].as_py())
        second = np.flatnonzero(tile == tab.column("high")[0].as_py())
        partners, root = _tile_pair(units, forms, tab.column("copies").to_numpy(), first, first if len(first) == len(nodes) else second, least)
        found = np.flatnonzero(partners)
        return pa.table({"node": nodes[found], "partners": partners[found], "root": nodes[root[found]]})

    # A number of its own keeps small but costly partitions apart.
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    key = [*group, "low", "high"]
    return dealt.repartition(parts, *key).groupBy(*key).applyInArrow(run, "node long, partners long, root long")


def near_vectors(vectors: DataFrame, least: float = LEAST, cells: int = CELLS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    n_links counts the other rows of the same label whose cosine is ``least`` or more,
    component_id is the smallest vec_id reachable by such links, kept tells whether it is
    the row's own. A vector that is null, empty or zero or holds null or non-finite entries,
    and a row without a label, link with nothing. Vectors of different lengths do not link.
    Repeated rows are rows of their own, so the kept rows of a repeated vec_id all say so.
    A null vec_id is passed over for the smallest; where there is no other, component_id is
    null and kept true. An empty table gives no rows. Other columns are ignored.
    """
    element = dict(vectors.dtypes)["embedding"]
    values = F.col("embedding") if element in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", values.alias("embedding"))
    alike = classes(vectors.filter(F.col("label").isNotNull() & usable(F.col("embedding"))))
    found = written(_links(alike, least, cells), "vector-links")
    partners = found.groupBy("node").agg(F.sum("partners").alias("partners"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = alike.select("node", "label", "embedding", "copies", "least_id").join(partners, "node", "left").join(roots, "node", "left")
    nodes = written(nodes.withColumn("root", F.coalesce("root", "node")), "vector-nodes")
    smallest = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    nodes = nodes.join(smallest, "root").select(
        "label", "embedding", "component_id", (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.lit(True).alias("linked")
    )
    # Rows of no class must not meet in one task: a null label never joins.
    label = F.when(usable(F.col("embedding")), F.col("label"))
    rows = vectors.withColumn("label", label).join(nodes, ["label", "embedding"], "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
