"""Exact top-k inner products over norm-sorted blocks.

Components are floor(1024 * x). Candidates lie in bands of falling norm, each band in blocks of
up to ``BLOCK`` rows, a block sorted by norm. An orthogonal rotation (the eigenvectors of the sum of outer
products, so the right singular vectors of all candidates) moves most of the length into the first
components. A query's k-th best score among the ``SEEDS`` longest candidates is its first bound; bands in which norm
times norm stays below the bound are never visited. In a block, the product of the first rotated components plus
the product of the residual norms (Cauchy-Schwarz) bounds each score from above; in two steps of more
components, pairs under the query's bound are dropped, and what is left is scored in whole numbers. Floating
point only prunes, with a margin above its rounding error.

Query blocks meet candidate blocks through a shuffled equi-join on the band, never a broadcast: a packed block is far
larger in memory than in its file, which the planner goes by. A block's results, at most k a query, are ranked
again at the end.

Defined cases: a row whose vector is null or holds null or non-finite components takes no part, nor does one with
a null id; missing components of shorter vectors count as zero; equal scores go to the smaller vec_id; rows
with the query's own vec_id are not its candidates, other repeated rows all are; a repeated query row is asked once;
a query without candidates has no rows; scores beyond 64 bits wrap. Extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import rows_at_once
from tidemark.settings import stored

SCALE = 1024
BLOCK = 4_096
QUERY_BLOCK = 2_048
#: Queries of a block whose products are in memory at once.
QUERY_ROWS = 512
BANDS = 256
SEEDS = 2_048
#: Shares of the rotated components after which pairs are dropped.
STEPS = (0.25, 0.5)
EXACT = float(1 << 53)


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<long>, norm) of the rows that take part."""
    fine = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
        .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .withColumn("norm", norm)
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists.to_pylist()):
        out[i, : len(x)] = x
    return out


def _outer_sums(width: int):
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column("v"), width).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width, dtype=np.int32)), pa.array(total.ravel())], ["at", "value"]
        )

    return run


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns by falling share of the candidates' squared length."""
    rows_at_once(vectors, 4_096)
    sums = vectors.select("v").mapInArrow(_outer_sums(width), "at int, value double").groupBy("at").sum("value")
    gram = np.zeros(width * width)
    for at, value in sums.collect():  # width * width rows
        gram[at] = value
    if not np.isfinite(gram).all():
        return np.eye(width)
    values, columns = np.linalg.eigh(gram.reshape(width, width))
    return columns[:, np.argsort(-values)]


def _pack(frame: pd.DataFrame, width: int) -> tuple[bytes, bytes]:
    frame = frame.sort_values(["norm", "vec_id"], ascending=[False, True], kind="stable")
    matrix = np.zeros((len(frame), width), np.int64)
    for i, x in enumerate(frame["v"]):
        matrix[i, : len(x)] = x
    return frame["vec_id"].to_numpy(np.int64).tobytes(), matrix.tobytes()


def _scores(q: np.ndarray, c: np.ndarray, exact: bool) -> np.ndarray:
    """Whole-number products; through floats where those are exact."""
    return (q.astype(float) @ c.T.astype(float)).astype(np.int64) if exact else q @ c.T


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity if there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, -k, axis=1)[:, -k]


def best_of_block(q_ids, q, bound, c_ids, c, turn, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of up to k best candidates of a block for each query, none under its bound."""
    qn, cn = np.sqrt((q.astype(float) ** 2).sum(1)), np.sqrt((c.astype(float) ** 2).sum(1))
    largest = float(qn.max(initial=0)) * float(cn.max(initial=0))
    exact = largest < EXACT
    width, margin = q.shape[1], 1e-9 * largest + 1e-6
    alive = np.ones((len(q), len(c)), bool)
    if exact:
        alive = qn[:, None] * cn[None, :] >= bound[:, None] - margin
        qr, cr = q @ turn, c @ turn
        done, partial = 0, np.zeros((len(q), len(c)))
        for share in STEPS:
            rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
            upto = max(done, int(width * share))
            if not len(rows) or upto == done:
                continue
            partial[np.ix_(rows, columns)] += qr[rows, done:upto] @ cr[columns, done:upto].T
            done = upto
            rest_q, rest_c = (np.sqrt((x[:, done:] ** 2).sum(1)) for x in (qr, cr))
            alive &= partial + rest_q[:, None] * rest_c[None, :] >= bound[:, None] - margin
    alive &= q_ids[:, None] != c_ids[None, :]
    rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
    out: list[list] = [[], [], []]
    if len(rows):
        scores = _scores(q[rows], c[columns], exact)
        for i, row in enumerate(rows):
            at = np.flatnonzero(alive[row, columns] & (scores[i] >= bound[row]))
            order = at[np.lexsort((c_ids[columns[at]], -scores[i, at]))][:k]
            out[0].append(np.full(len(order), q_ids[row]))
            out[1].append(c_ids[columns[order]])
            out[2].append(scores[i, order])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def top_products(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = stored(whole_numbers(vectors), "vectors")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width, schema = facts["width"] or 1, "query_id long, vec_id long, score long"
    turn = spark.sparkContext.broadcast(rotation(rows, width))

    # Bands of falling norm: the bounds are a fixed number of quantiles.
    many = max(1, min(BANDS, facts["n"] // BLOCK))
    cuts = rows.agg(F.percentile_approx("norm", [i / many for i in range(1, many)] or [0.5], 10_000)).first()[0]
    cuts = sorted(set(cuts or []), reverse=True) if many > 1 else []
    band = F.lit(0)
    if cuts:
        band = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda x: x >= F.col("norm")))
    blocks = max(1, -(-facts["n"] // (max(1, len(cuts) + 1) * BLOCK)))
    dealt = rows.withColumn("band", band).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))

    def pack_block(key, frame: pd.DataFrame) -> pd.DataFrame:
        ids, matrix = _pack(frame, width)
        return pd.DataFrame({"band": [key[0]], "top": [frame["norm"].max()], "ids": [ids], "matrix": [matrix]})

    rows_at_once(rows, 4_096)
    candidates = stored(
        dealt.groupBy("band", "block").applyInPandas(pack_block, "band int, top double, ids binary, matrix binary"),
        "candidates",
    )
    tops = [(r["band"], r["top"]) for r in candidates.groupBy("band").agg(F.max("top").alias("top")).collect()]

    longest = rows.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).collect()  # a fixed number of rows
    seed_ids = np.array([r["vec_id"] for r in longest], np.int64)
    seed = np.zeros((len(longest), width), np.int64)
    for i, r in enumerate(longest):
        seed[i, : len(r["v"])] = r["v"]
    seeds = spark.sparkContext.broadcast((seed_ids, seed))
    asked = rows.where(is_query).dropDuplicates(["vec_id"])
    groups = max(1, -(-asked.count() // QUERY_BLOCK))

    def pack_queries(frame: pd.DataFrame) -> pd.DataFrame:
        ids, matrix = _pack(frame, width)
        q_ids, q = np.frombuffer(ids, np.int64), np.frombuffer(matrix, np.int64).reshape(-1, width)
        ids_, seed_ = seeds.value
        norms = np.sqrt((q.astype(float) ** 2).sum(1))
        exact = float(norms.max(initial=0)) * float(np.sqrt((seed_.astype(float) ** 2).sum(1)).max(initial=0)) < EXACT
        scores = _scores(q, seed_, exact).astype(float)
        scores[q_ids[:, None] == ids_[None, :]] = -np.inf
        bound = _kth(scores, k) if exact else np.full(len(q), -np.inf)
        visits = [b for b, top in tops if (norms * top >= bound - 1e-9 * norms * top - 1e-6).any()]
        return pd.DataFrame({"visits": [visits], "q_ids": [ids], "q": [matrix], "bound": [bound.tobytes()]})

    queries = stored(
        asked.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups))).groupBy("group")
        .applyInPandas(pack_queries, "visits array<int>, q_ids binary, q binary, bound binary"),
        "queries",
    )

    def meet(batches):
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, q, c_ids, c = (np.frombuffer(r[c], np.int64) for c in ("q_ids", "q", "ids", "matrix"))
                q, c, bound = q.reshape(-1, width), c.reshape(-1, width), np.frombuffer(r["bound"], float)
                for begin in range(0, len(q_ids), QUERY_ROWS):
                    some = slice(begin, begin + QUERY_ROWS)
                    found = best_of_block(q_ids[some], q[some], bound[some], c_ids, c, turn.value, k)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

    visits = queries.withColumn("band", F.explode("visits")).drop("visits")
    met = visits.join(candidates.drop("top").hint("merge"), "band")
    rows_at_once(met, 4)
    found = stored(met.mapInArrow(meet, schema), "products")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
