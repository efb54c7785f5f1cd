"""Hard negatives of anchors, by bounds along a spanning tree of the anchors.

Scores are inner products of whole-number vectors. Anchors are put into blocks of about ``BLOCK_ANCHORS`` along
a space-filling curve, by label first, so that neighbours meet; the minimum spanning tree of a block's anchors
is worked out once. All rows are dealt into chunks of about ``CHUNK_ROWS``, and each block meets each chunk in
one group: the stated anchors against all rows, in blocks.

In a group the tree is walked from its root. A child's score lies within edge length times candidate norm of
the parent's, which is known or itself between bounds. Only candidates whose bounds overlap a window that still
matters are rescored: for positives the scores that can reach the first ``positives`` of the label, for
negatives the window below each positive's score, there too from the first ``negatives`` that are sure to be
in it. What is not rescored passes its wider bounds on. Bounds are widened by the rounding of floats, so no
row is lost; scores are exact.

A group gives each anchor the best few of its chunk, and these are ranked over the chunks; no anchor, label or
hot vector gathers its candidates in one task.

Corner cases: rows with a null label or vector, or a null or non-finite component or one whose whole number has
more than 27 bits (whose products could overflow), take no part; a null id is never an anchor and comes last
among ties; missing components of shorter vectors are 0; copies of an anchor (equal id, label and vector) are
one anchor, other rows that share its id are anchors too; a row is not compared with rows of its own id;
repeated rows take a rank each; a negative positive's window is empty; an empty table gives no rows; other
columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.common import stored
from delaykit.llm.packing import hilbert_keys
from delaykit.operators.numbering import numbered

POSITIVES, NEGATIVES = 5, 5
#: Window of a negative's score, in per cent of the positive's.
LOW, HIGH = 80, 100
SCALE = 256
BLOCK_ANCHORS, CHUNK_ROWS = 512, 8192
LARGEST = 1 << 27
DIMENSIONS, BITS = 4, 15


def whole_rows(rows: DataFrame, is_anchor: Column, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, v, anchor): rows that take part, with floor(scale * x) of each component."""
    vector = F.col(vector_col)
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(scaled(x)) < float(LARGEST), F.lit(False)))
    kept = rows.filter(F.col(label_col).isNotNull() & vector.isNotNull() & fine)
    return kept.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"),
        F.transform(vector, lambda x: F.floor(scaled(x)).cast("int")).alias("v"), is_anchor.alias("anchor"),
    )


def matrix(column, width: int = 0) -> np.ndarray:
    """Vectors as rows of whole numbers in float64, short ones filled up by 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) * width == len(values):
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def with_curve_key(anchors: DataFrame) -> DataFrame:
    """``anchors`` with ``key``: the place of a projection of the vector along a Hilbert curve."""

    def run(batches):
        for batch in batches:
            vectors = matrix(batch.column(batch.schema.get_field_index("v")))
            # The same directions in every batch, whatever the longest vector there.
            signs = np.array([[1.0 if (k * 2654435761 >> (7 + 5 * d)) & 1 else -1.0 for d in range(DIMENSIONS)] for k in range(vectors.shape[1])])
            points = vectors @ signs.reshape(-1, DIMENSIONS) / np.maximum(1.0, np.sqrt((vectors**2).sum(1)))[:, None]
            cells = np.clip((0.5 + 0.5 * np.tanh(points)) * (1 << BITS), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells))], [*batch.schema.names, "key"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema)
    return anchors.mapInArrow(run, f"{kinds}, key bigint")


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(row, place of its parent or -1, edge length) of a minimum spanning tree, parents first."""
    norms = (vectors**2).sum(1)
    best, near = np.full(len(vectors), np.inf), np.full(len(vectors), -1)
    left = np.ones(len(vectors), bool)
    out: list[tuple[int, int, float]] = []
    row, parent, edge = 0, -1, 0.0
    while True:
        left[row] = False
        out.append((row, parent, edge))
        if not left.any():
            return out
        far = np.maximum(0.0, norms + norms[row] - 2 * (vectors @ vectors[row]))
        closer = left & (far < best)
        best[closer], near[closer] = far[closer], len(out) - 1
        row = int(np.argmin(np.where(left, best, np.inf)))
        parent, edge = int(near[row]), math.sqrt(best[row])


def anchor_trees(anchors: DataFrame, block_anchors: int) -> DataFrame:
    """(block, place, parent, edge, id, label, v): the anchors of each block, parents first."""
    ordered = numbered(with_curve_key(anchors), ["label", "key", "id", "v"])
    blocked = ordered.withColumn("block", F.floor(F.col("number") / block_anchors)).drop("key", "number")

    def run(table: pa.Table) -> pa.Table:
        tree = spanning_tree(matrix(table["v"]))
        rows = table.take(pa.array([row for row, _, _ in tree]))
        for k, (name, kind) in enumerate((("place", pa.int64()), ("parent", pa.int64()), ("edge", pa.float64()))):
            values = range(len(tree)) if k == 0 else [node[k] for node in tree]
            rows = rows.append_column(name, pa.array(values, kind))
        return rows.select(["block", "place", "parent", "edge", "id", "label", "v"])

    kinds = {f.name: f.dataType.simpleString() for f in anchors.schema}
    return blocked.groupBy("block").applyInArrow(
        run, f"block bigint, place bigint, parent bigint, edge double, id {kinds['id']}, label {kinds['label']}, v {kinds['v']}"
    )


def first(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Positions in ``at`` of the k highest scores; of equal ones those that come first."""
    if len(scores) > 8 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
        return keep[np.lexsort((at[keep], -scores[keep]))[:k]]
    return np.lexsort((at, -scores))[:k]


def scored(trees: DataFrame, rows: DataFrame, chunks: int, blocks: int, k: int, windows: bool, low: int, high: int) -> DataFrame:
    """(block, place, anchor, wanted, score, id): the first ``k`` of each chunk for each anchor.

    Without ``windows`` of the anchor's label, ``wanted`` being null; else of other labels, for each score in
    the anchor's ``wanted`` those between ``low`` and ``high`` per cent of it.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["block", "place", "anchor", "wanted", "score", "id"]
        types = [pa.int64(), pa.int64(), right.schema.field("id").type, pa.int64(), pa.int64(), left.schema.field("id").type]
        if not len(left) or not len(right):
            return pa.table([pa.array([], t) for t in types], names)
        left = left.take(pc.sort_indices(left, [("id", "ascending")], null_placement="at_end"))
        right = right.take(pc.sort_indices(right, [("place", "ascending")]))
        wide = max(max((c.value_lengths().to_numpy(zero_copy_only=False).max(initial=0) for c in column.chunks), default=0) for column in (left["v"], right["v"]))
        x, a = matrix(left["v"], int(wide)), matrix(right["v"], int(wide))
        norms = np.sqrt((x**2).sum(1))
        # Products that float64 cannot hold are summed as whole numbers.
        exact = float(np.abs(x).max(initial=0)) * float(np.abs(a).max(initial=0)) * max(1, wide) < 2.0**53
        slack = 1e-9 * float(norms.max(initial=0)) * float(np.sqrt((a**2).sum(1)).max(initial=0)) + 1.0
        whole_x, whole_a = (None, None) if exact else (x.astype(np.int64), a.astype(np.int64))
        codes: dict = {}
        label_x = np.array([codes.setdefault(v, len(codes)) for v in left["label"].to_pylist()])
        label_a = [codes.setdefault(v, len(codes)) for v in right["label"].to_pylist()]
        parents, edges, anchors = right["parent"].to_pylist(), right["edge"].to_pylist(), right["id"]
        asked = right["wanted"].to_pylist() if windows else [None] * len(a)
        blocks_of = right["block"].to_pylist()
        ids = left["id"].combine_chunks()
        lows, highs = [], []
        out: list[tuple] = []
        taken: list[np.ndarray] = []
        for place in range(len(a)):
            if parents[place] < 0:
                lo, hi = np.full(len(x), -np.inf), np.full(len(x), np.inf)
            else:
                reach = edges[place] * (1 + 1e-9) * norms + slack
                lo, hi = lows[parents[place]] - reach, highs[parents[place]] + reach
            allowed = (label_x != label_a[place]) if windows else (label_x == label_a[place])
            allowed &= ~pc.fill_null(pc.equal(ids, anchors[place]), False).to_numpy(zero_copy_only=False)
            bounds = [(-((-low * p) // 100), (high * p) // 100, p) for p in sorted(set(asked[place] or ()))] if windows else [(-math.inf, math.inf, None)]
            need = np.zeros(len(x), bool)
            for least, most, _ in bounds:
                sure = lo[allowed & (lo >= least) & (hi <= most)]
                enough = np.partition(sure, len(sure) - k)[len(sure) - k] if len(sure) >= k else -np.inf
                need |= allowed & (hi >= max(least, enough)) & (lo <= most)
            if parents[place] < 0:
                need[:] = True
            at = np.flatnonzero(need)
            scores = (x[at] @ a[place]) if exact else (whole_x[at] @ whole_a[place])
            lo[at], hi[at] = scores, scores
            lows.append(lo)
            highs.append(hi)
            own = allowed[at]
            for least, most, wanted in bounds:
                inside = np.flatnonzero(own & (scores >= least) & (scores <= most))
                best = inside[first(scores[inside], at[inside], k)]
                taken.append(at[best])
                out += [(blocks_of[place], place, place, wanted, int(s)) for s in scores[best]]
        positions = np.concatenate(taken) if taken else np.zeros(0, np.int64)
        columns = [pa.array([r[c] for r in out], t) for c, t in ((0, types[0]), (1, types[1]))]
        columns.append(anchors.combine_chunks().take(pa.array([r[2] for r in out], pa.int64())))
        columns += [pa.array([r[c] for r in out], t) for c, t in ((3, types[3]), (4, types[4]))]
        columns.append(ids.take(pa.array(positions, pa.int64())))
        return pa.table(columns, names)

    kind = rows.schema["id"].dataType.simpleString()
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    here = rows.withColumn("block", all_of(blocks)).groupBy("block", "chunk")
    there = trees.withColumn("chunk", all_of(chunks)).groupBy("block", "chunk")
    return here.cogroup(there).applyInArrow(
        run, f"block bigint, place bigint, anchor {kind}, wanted bigint, score bigint, id {kind}"
    )


def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: int = SCALE, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    block_anchors: int = BLOCK_ANCHORS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``is_anchor`` is a condition on the columns of ``rows``. An anchor's positives are its ``positives`` best rows of the
    same label; each has the ``negatives`` best rows of other labels that score between ``low`` and ``high``
    per cent of it.
    """
    known = whole_rows(rows, is_anchor, id_col, label_col, vector_col, scale)
    known = stored(known.withColumn("row", F.monotonically_increasing_id()), "vectors")
    anchors = known.filter("anchor").select("id", "label", "v").distinct()
    trees = stored(anchor_trees(anchors, block_anchors), "trees")
    chunks = max(1, math.ceil(known.count() / chunk_rows))
    blocks = max(1, math.ceil(trees.count() / block_anchors))
    candidates = known.select("id", "label", "v", F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk"))
    near = scored(trees, candidates, chunks, blocks, positives, False, low, high)
    near = stored(ranked(near, ["block", "place"], positives), "positives").select(
        "block", "place", F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    asked = near.groupBy("block", "place").agg(F.collect_set("positive_score").alias("wanted"))
    hard = scored(trees.join(asked, ["block", "place"], "left"), candidates, chunks, blocks, negatives, True, low, high)
    hard = ranked(hard, ["block", "place", "wanted"], negatives).select(
        "block", "place", F.col("wanted").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return near.join(hard, ["block", "place", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
