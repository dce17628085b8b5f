"""Vector codes by product quantisation with exact integer arithmetic
(operator 12).

A vector is cut into equal consecutive parts, and each part is replaced by the
index of the nearest entry (squared Euclidean distance, ties to the lower
index) of that position's codebook. A round assigns all parts and then replaces
every entry by the floored mean of its parts.

Rounds after the first use norm-of-sum bounds. Every part keeps an upper bound
of the distance to its entry and a lower bound of the distance to every other
entry, each stamped with the round whose codebook it was measured against, and
the history of all codebooks is kept. A bound is brought to the present by the
true net displacement |c(now) - c(stamp)| of the entries, which is at most the
sum of their drifts from round to round. Where the upper bound stays below the
lower one the part keeps its code unseen; else the distance to its entry is
measured, and only if that does not settle it all entries are scanned again.
Codes are exact: bounds are compared with a margin above rounding errors, and a
possible tie always leads to a scan.

Codebooks are at most 64 entries of integers for each part and go to the tasks
with the function; their sums come back as one row per entry and component. The
state of a round (codes, bounds, stamps) is a table in the shared folder.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped; with fewer than 64 rows the codebooks have as many entries; rows
that repeat a vec_id are coded each on its own, and null ids come after all
others when the first entries are drawn; null labels are one label; an empty
table gives no rows. Vectors of different lengths, or of a length that the
parts do not divide, and components beyond 2 ** 26 after scaling raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nbsieve.llm.common import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LIMIT = 1 << 26
BROADCAST_ROWS = 200_000    # distinct labels broadcast with their sums; beyond it, a shuffled join
MARGIN = 1e-9

Codebooks = np.ndarray      # int64, (parts, entries, width)


def scaled(rows: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, q): rows with finite vectors, components as integers."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    q = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return rows.filter(x.isNotNull() & finite).select("vec_id", "label", q.alias("q"))


def _list(column: pa.Array, width: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    offsets = pa.array((np.arange(n + 1) * width).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), kind))


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``x`` to all entries of ``book``."""
    out = np.zeros((len(x), len(book)), dtype=np.int64)
    for j in range(x.shape[1]):                     # a few components: no third axis
        out += (x[:, j, None] - book[None, :, j]) ** 2
    return out


class Displacement:
    """Net movement of a position's entries from each stamped codebook to the
    present one."""

    def __init__(self, history: list[np.ndarray]):
        self.own = np.array([np.sqrt(((history[-1] - h) ** 2).sum(axis=1).astype(float))
                             for h in history])     # (stamp, entry)
        order = np.argsort(self.own, axis=1)
        stamp = np.arange(len(history))
        self.first = order[:, -1]
        self.most = self.own[stamp, self.first]
        self.second = self.own[stamp, order[:, -2]] if self.own.shape[1] > 1 else 0 * self.most

    def others(self, stamps: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Largest movement of any entry but the part's own."""
        return np.where(self.first[stamps] == codes, self.second[stamps], self.most[stamps])


def assign(x: np.ndarray, history: list[np.ndarray], codes: np.ndarray, upper: np.ndarray,
           upper_at: np.ndarray, lower: np.ndarray, lower_at: np.ndarray) -> int:
    """Bring codes, bounds and stamps of the parts ``x`` of one position to the
    last codebook of ``history``, in place; returns how many were scanned."""
    now, book = len(history) - 1, history[-1]
    if now == 0:
        scan = np.arange(len(x))
    else:
        moved = Displacement(history)
        low = lower - moved.others(lower_at, codes)
        low -= MARGIN * (1 + np.abs(lower))
        high = upper + moved.own[upper_at, codes]
        doubt = np.flatnonzero(high * (1 + MARGIN) + MARGIN >= low)
        exact = np.sqrt(((x[doubt] - book[codes[doubt]]) ** 2).sum(axis=1).astype(float))
        upper[doubt], upper_at[doubt] = exact, now
        scan = doubt[exact * (1 + MARGIN) + MARGIN >= low[doubt]]
    for at in range(0, len(scan), 4096):
        rows = scan[at:at + 4096]
        d = squared(x[rows], book)
        code = d.argmin(axis=1)                     # the first of equal ones
        each = np.arange(len(rows))
        codes[rows] = code
        upper[rows] = np.sqrt(d[each, code].astype(float))
        d[each, code] = np.iinfo(np.int64).max
        lower[rows] = np.sqrt(d.min(axis=1).astype(float)) if d.shape[1] > 1 else np.inf
        upper_at[rows] = lower_at[rows] = now
    return len(scan)


def _state_type(rows: DataFrame) -> T.StructType:
    fields = [rows.schema["vec_id"], rows.schema["label"],
              T.StructField("q", T.ArrayType(T.LongType()))]
    for name, kind in (("codes", T.ShortType()), ("upper", T.DoubleType()),
                       ("upper_at", T.ShortType()), ("lower", T.DoubleType()),
                       ("lower_at", T.ShortType())):
        fields.append(T.StructField(name, T.ArrayType(kind)))
    return T.StructType([*fields, T.StructField("scanned", T.IntegerType())])


def assigned(rows: DataFrame, history: list[Codebooks]) -> DataFrame:
    """``rows`` (scaled vectors, or the state of the round before) with codes,
    bounds and stamps of the last codebooks of ``history``; ``scanned`` counts
    the parts of a row for which all entries were measured."""
    parts, _, width = history[0].shape
    first = len(history) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            q = _list(batch.column("q"), parts * width, np.int64).reshape(n, parts, width)
            shape = (n, parts)
            if first:
                codes, upper_at, lower_at = (np.zeros(shape, np.int64) for _ in range(3))
                upper, lower = np.zeros(shape), np.zeros(shape)
            else:
                codes, upper_at, lower_at = (_list(batch.column(c), parts, np.int64)
                                             for c in ("codes", "upper_at", "lower_at"))
                upper, lower = (_list(batch.column(c), parts, float) for c in ("upper", "lower"))
            scanned = np.zeros(n, dtype=np.int32)
            for p in range(parts):
                state = [np.ascontiguousarray(a[:, p])
                         for a in (codes, upper, upper_at, lower, lower_at)]
                assign(q[:, p], [h[p] for h in history], *state)
                scanned += state[4] == len(history) - 1
                for a, s in zip((codes, upper, upper_at, lower, lower_at), state, strict=True):
                    a[:, p] = s
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("q"),
                 _lists(codes, pa.int16()), _lists(upper, pa.float64()),
                 _lists(upper_at, pa.int16()), _lists(lower, pa.float64()),
                 _lists(lower_at, pa.int16()), pa.array(scanned)],
                names=["vec_id", "label", "q", "codes", "upper", "upper_at", "lower", "lower_at",
                       "scanned"])

    return rows.mapInArrow(run, _state_type(rows))


def updated(state: DataFrame, books: Codebooks) -> Codebooks:
    """Entries replaced by the floored means of their parts; unused ones stay."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), dtype=np.int64)
        count = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _list(batch.column("q"), parts * width, np.int64).reshape(-1, parts, width)
            codes = _list(batch.column("codes"), parts, np.int64)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(total[p], codes[:, p], q[:, p])
        p, j = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(count[p, j]),
             _lists(total[p, j], pa.int64())], names=["part", "entry", "n", "total"])

    rows = state.select("q", "codes").mapInArrow(
        sums, "part int, entry int, n bigint, total array<bigint>")
    flat = rows.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
    out = books.copy()
    for r in flat.groupBy("part", "entry", "at").agg(  # one row per component of an entry
            F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
        out[r["part"], r["entry"], r["at"]] = r["x"] // r["n"]
    return out


def first_books(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the first rows by vec_id; None of an empty table."""
    top = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    if not top:
        return None
    q = np.array([r["q"] for r in top], dtype=np.int64)
    return np.ascontiguousarray(q.reshape(len(q), parts, -1).transpose(1, 0, 2))


def vector_codes(vectors: DataFrame, vector_col: str = "embedding", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[Codebooks]]:
    """(state of the last assignment, history of the codebooks)."""
    rows = stored(scaled(vectors, vector_col), "vectors")
    least, most, high = rows.agg(
        F.min(F.size("q")), F.max(F.size("q")),
        F.max(F.greatest(F.array_max("q"), -F.array_min("q")))).first()
    if least is not None and (least != most or least % parts or not least):
        raise ValueError(f"vectors need one length that {parts} divides, not {least} to {most}")
    if high is not None and high > LIMIT:
        raise ValueError(f"components must be within {LIMIT / SCALE:g}")
    start = first_books(rows, parts, entries)
    if start is None:
        return assigned(rows, [np.zeros((parts, 1, 1), np.int64)]), []
    history, state = [start], rows
    for k in range(rounds):
        state = stored(assigned(state, history), f"vector-codes-{k}")
        history.append(updated(state, history[-1]))
    return assigned(state, history), history


def codebook_digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op12_vector_codes(vectors: DataFrame) -> DataFrame:
    state, history = vector_codes(vectors)
    label = state.schema["label"]
    if history:
        books = history[-1]
        parts, _, width = books.shape

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = _list(batch.column("q"), parts * width, np.int64).reshape(-1, parts, width)
                codes = _list(batch.column("codes"), parts, np.int64)
                error = sum(((q[:, p] - books[p][codes[:, p]]) ** 2).sum(axis=1)
                            for p in range(parts))
                text = codes.astype(np.uint8).tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"),
                     pa.array([text[k:k + step] for k in range(0, len(text), step)], pa.string()),
                     pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

        rows = state.select("vec_id", "label", "q", "codes").mapInArrow(coded, T.StructType(
            [state.schema["vec_id"], label, T.StructField("code", T.StringType()),
             T.StructField("error", T.LongType())]))
        digest = codebook_digest(books)
    else:
        rows = state.limit(0).select("vec_id", "label", F.lit("").alias("code"),
                                     F.lit(0).cast("long").alias("error"))
        digest = ""
    rows = stored(rows, "vector-errors")
    totals = stored(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")),
                    "vector-labels")
    side = F.broadcast(totals) if totals.count() <= BROADCAST_ROWS else totals
    return rows.join(side, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    """The same rounds in SQL, for vectors of 64 components."""
    xs = ", ".join(f"q[4 * p + {j + 1}] AS x{j}" for j in range(4))
    diff = " + ".join(f"(x{j} - c{j}) * (x{j} - c{j})" for j in range(4))
    sql = f"""WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, {xs} FROM kept, range(0, 16) AS t(p)),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p, j, x0 AS c0, x1 AS c1, x2 AS c2, x3 AS c3 FROM parts JOIN first USING (r))"""
    for k in range(3):
        sql += f""",
near{k} AS (SELECT r, p, min({{'d': {diff}, 'j': j}}) AS best FROM parts JOIN book{k} USING (p) GROUP BY r, p)"""
        if k < 2:
            mean = ", ".join(f"floor(sum(x{j}) / count(*))::BIGINT AS m{j}" for j in range(4))
            pick = ", ".join(f"coalesce(m{j}, c{j}) AS c{j}" for j in range(4))
            sql += f""",
book{k + 1} AS (
  SELECT p, j, {pick} FROM book{k} LEFT JOIN (
    SELECT p, best.j AS j, {mean} FROM near{k} JOIN parts USING (r, p) GROUP BY ALL) USING (p, j))"""
    return sql + """,
coded AS (SELECT r, string_agg(format('{:02x}', best.j::INT), '' ORDER BY p) AS code,
            sum(best.d)::BIGINT AS error FROM near2 GROUP BY r),
digest AS (SELECT sha256(string_agg(c0 || ',' || c1 || ',' || c2 || ',' || c3, ',' ORDER BY p, j)) AS h FROM book2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  h AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


ORACLE = _oracle()
