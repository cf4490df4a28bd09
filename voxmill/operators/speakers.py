"""Speakers: clusters of a file's embeddings, and segments with two voices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import workspace
from ..functions import vectors

#: Rows of a file that one task clusters with a matrix of distances (128 MB, twice that while it is made).
TASK_ROWS = 4000
#: Rows of a block, of which a task compares two, and of a strip, the rows compared with a block at once.
#: Each row is sent once for each block of its file.
BLOCK_ROWS, STRIP_ROWS = 8192, 512


def units(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def average_linkage(x: np.ndarray, threshold: float, sizes: np.ndarray | None = None) -> np.ndarray:
    """Labels of agglomerative clusters by cosine distance, merged up to the threshold.

    Labels count up in the order of each cluster's first row. With ``sizes``, rows are clusters
    already, each given by the mean of its unit vectors.
    """
    n = len(x)
    unit = units(x) if sizes is None else x
    apart = unit @ unit.T
    np.subtract(1, apart, out=apart)
    np.fill_diagonal(apart, np.inf)
    near = apart.argmin(axis=1)  # each row's nearest, kept up so that no step searches the matrix
    least = apart[np.arange(n), near]
    size, owner, alive = np.ones(n) if sizes is None else sizes.astype(np.float64), np.arange(n), n
    while alive > 1:
        i = least.argmin()
        if least[i] >= threshold:
            break
        i, j = min(i, near[i]), max(i, near[i])
        row = (apart[i] * size[i] + apart[j] * size[j]) / (size[i] + size[j])
        apart[i], apart[:, i] = row, row
        apart[i, i] = np.inf
        apart[j], apart[:, j] = np.inf, np.inf
        row = apart[i]
        stale = ((near == i) | (near == j)) & ~(row <= least)
        nearer = (row < least) | ((row == least) & (i < near))  # of equals the first
        near[nearer], least[nearer] = i, row[nearer]
        stale[i], stale[j], least[j] = True, False, np.inf
        stale = np.flatnonzero(stale)
        near[stale] = apart[stale].argmin(axis=1)
        least[stale] = apart[stale, near[stale]]
        size[i] += size[j]
        owner[owner == j] = i
        alive -= 1
    first = {o: k for k, o in reversed(list(enumerate(owner.tolist())))}
    rank = {o: r for r, o in enumerate(sorted(first, key=first.get))}
    return np.array([rank[o] for o in owner.tolist()])


def _closest(left: np.ndarray, right: np.ndarray, same: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """The least distance and its place in the other block, for each row of both; of one block if they are the same.

    Of equals the first. No more than a strip's distances are held at once.
    """
    to, across = np.empty(len(left), np.int64), np.empty(len(left))
    at, down = np.zeros(len(right), np.int64), np.full(len(right), np.inf)
    for start in range(0, len(left), STRIP_ROWS):
        apart = 1 - left[start : start + STRIP_ROWS] @ right.T
        rows = np.arange(len(apart))
        if same:
            apart[rows, start + rows] = np.inf
        best = apart.argmin(axis=1)
        to[start : start + len(rows)], across[start : start + len(rows)] = best, apart[rows, best]
        best = apart.argmin(axis=0)
        found = apart[best, np.arange(len(right))]
        nearer = found < down
        at[nearer], down[nearer] = start + best[nearer], found[nearer]
    if not same:
        return [(across, to), (down, at)]
    # rounding may differ between both directions of a pair, which has the lesser
    nearer = (down < across) | ((down == across) & (at < to))
    return [(np.where(nearer, down, across), np.where(nearer, at, to))]


def _nearest(state: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """key, lo, hi: each cluster's nearest one below the threshold; of equals the first."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        keys, means = pdf["key"].to_numpy(), np.stack(pdf["total"].to_numpy()) / pdf["n"].to_numpy()[:, None]
        left = (pdf["side"] < 2).to_numpy()
        right = ~left if (~left).any() or pdf["low"].iloc[0] != pdf["high"].iloc[0] else left
        out = []
        if left.any() and right.any():
            sides = _closest(means[left], means[right], right is left)
            for own, other, (apart, at) in zip((keys[left], keys[right]), (keys[right], keys[left]), sides, strict=False):
                out.append(pd.DataFrame({"key": own, "apart": apart, "other": other[at]}))
        found = pd.concat(out) if out else pd.DataFrame({"key": [], "apart": [], "other": []})
        return found[found["apart"] < threshold]

    tile, other = F.pmod(F.xxhash64("key"), F.col("tiles")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    rows = state.join(F.broadcast(groups), "g").withColumn("tile", tile).withColumn("other", other)
    side = F.when(F.col("tile") <= F.col("other"), 1).otherwise(2)
    rows = rows.select("g", "key", "n", "total", side.alias("side"), F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    met = rows.groupBy("g", "low", "high").applyInPandas(run, "key long, apart double, other long")
    pair = F.struct("apart", F.least("key", "other").alias("lo"), F.greatest("key", "other").alias("hi"))
    return met.groupBy("key").agg(F.min(pair).alias("p")).select("key", "p.lo", "p.hi")


def _large_clusters(rows: DataFrame, threshold: float) -> DataFrame:
    """As ``clusters``, for files of any size. ``rows``: also g, the file's number.

    The mean distance of two clusters is one less the product of their mean unit vectors, so a
    cluster is a sum and a size. Each round compares blocks of a file pairwise and joins all
    clusters that are nearest to each other. A merged cluster is never nearer to a third than
    the nearer of its parts was, so this makes the clusters that merging the nearest pair again
    and again makes (but for equal distances), and a cluster without one below the threshold is
    done. What is left of a file is clustered in one task when it has TASK_ROWS clusters or fewer.
    """

    @F.pandas_udf("array<double>")
    def unit(x: pd.Series) -> pd.Series:
        return pd.Series(list(units(np.stack(x.to_numpy()).astype(np.float64)))) if len(x) else x

    def rest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        keys, n = pdf["key"].to_numpy(), pdf["n"].to_numpy()
        labels = average_linkage(np.stack(pdf["total"].to_numpy()) / n[:, None], threshold, n)
        firsts = keys[np.unique(labels, return_index=True)[1]]
        return pd.DataFrame({"hi": keys, "lo": firsts[labels]}).query("hi != lo")

    rows = workspace.saved(rows.withColumn("key", F.monotonically_increasing_id()), "segments")
    members = rows.select("file_id", "id", "g", "key", F.col("key").alias("cluster"))
    state = workspace.saved(rows.select("g", "key", F.lit(1).cast("long").alias("n"), unit("embedding").alias("total")), "clusters")

    def moved(pairs: DataFrame) -> DataFrame:
        met = members.join(pairs.select(F.col("hi").alias("cluster"), "lo"), "cluster", "left")
        return workspace.saved(met.select("file_id", "id", "g", "key", F.coalesce("lo", "cluster").alias("cluster")), "members")

    while True:
        groups = state.groupBy("g").agg(F.count("*").alias("rows")).filter(F.col("rows") > TASK_ROWS)
        groups = workspace.saved(groups.select("g", F.ceil(F.col("rows") / BLOCK_ROWS).cast("long").alias("tiles")), "groups")
        if groups.isEmpty():
            break
        near = workspace.saved(_nearest(state, groups, threshold), "nearest")
        pairs = workspace.saved(near.groupBy("lo", "hi").agg(F.count("*").alias("ends")).filter("ends = 2").select("lo", "hi"), "pairs")
        members = moved(pairs)
        going = state.join(near.select("key"), "key").join(pairs.withColumnRenamed("hi", "key"), "key", "left")
        both = going.groupBy("g", F.coalesce("lo", "key").alias("key")).agg(F.sum("n").alias("n"), F.collect_list("total").alias("t"))
        total = F.when(F.size("t") == 2, F.zip_with(F.col("t")[0], F.get("t", F.lit(1)), lambda a, b: a + b)).otherwise(F.col("t")[0])
        waiting = state.join(F.broadcast(groups), "g", "left_anti").select("g", "key", "n", "total")
        state = workspace.saved(both.select("g", "key", "n", total.alias("total")).unionByName(waiting), "clusters")
    members = moved(state.groupBy("g").applyInPandas(rest, "hi long, lo long"))

    # ranks of a file's clusters by their first rows: in ranges, then the ranges' sums
    firsts = members.groupBy("g", "cluster").agg(F.min(F.struct("id", "key")).alias("first"))
    firsts = firsts.repartitionByRange("g", "first").withColumn("range", F.spark_partition_id())
    firsts = workspace.saved(firsts, "firsts")
    before = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = firsts.groupBy("g", "range").agg(F.count("*").alias("c")).select("g", "range", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    ranked = firsts.withColumn("k", F.row_number().over(Window.partitionBy("g", "range").orderBy("first"))).join(ranges, ["g", "range"])
    named = ranked.select("cluster", (F.col("base") + F.col("k") - 1).cast("string").alias("rank"))
    file = F.coalesce(F.col("file_id").cast("string"), F.lit("None"))
    return members.join(named, "cluster").select("file_id", "id", F.concat(file, F.lit("_spk"), "rank").alias("speaker_id"))


def clusters(segments: DataFrame, threshold: float = 0.35) -> DataFrame:
    """file_id, id, speaker_id. ``segments``: file_id, id, embedding; a file is one group.

    Files of more than TASK_ROWS rows are clustered in rounds over all executors.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        labels = average_linkage(np.stack(pdf["embedding"].to_numpy()).astype(np.float64), threshold)
        names = [f"{f}_spk{k}" for f, k in zip(pdf["file_id"], labels, strict=True)]
        return pd.DataFrame({"file_id": pdf["file_id"], "id": pdf["id"], "speaker_id": names})

    kinds = {f.name: f.dataType.simpleString() for f in segments.schema.fields}
    schema = f"file_id {kinds['file_id']}, id {kinds['id']}, speaker_id string"
    large = segments.groupBy(F.col("file_id").alias("f")).agg(F.count("*").alias("rows")).filter(F.col("rows") > TASK_ROWS)
    large = workspace.saved(large.select("f", F.monotonically_increasing_id().alias("g")), "large_files")
    if large.isEmpty():
        return segments.groupBy("file_id").applyInPandas(run, schema)
    is_large = F.col("file_id").eqNullSafe(F.col("f"))
    small = segments.join(F.broadcast(large), is_large, "left_anti").groupBy("file_id").applyInPandas(run, schema)
    return small.unionByName(_large_clusters(segments.join(F.broadcast(large), is_large).drop("f"), threshold))


def has_two_voices(first: Column, second: Column, seconds: Column, threshold: float = 0.45) -> Column:
    """Whether the halves' embeddings are apart; unknown for segments under two seconds."""
    return F.when(seconds >= 2, vectors.cosine_distance(first, second) > threshold)


def dominant(turns: DataFrame) -> DataFrame:
    """segment, speaker, multi_speaker of diarised turns (segment, speaker, seconds)."""
    sums = turns.groupBy("segment", "speaker").agg(F.sum("seconds").alias("seconds"))
    return sums.groupBy("segment").agg(F.max_by("speaker", F.struct("seconds", "speaker")).alias("speaker"), (F.count("*") > 1).alias("multi_speaker"))
