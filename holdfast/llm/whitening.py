"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the centred rows, right vectors v and left vectors u are built in turn: u follows from
Xv, rows times a small vector, and v from X'u, a sum over rows. Both are reorthogonalised
against all earlier ones. X = U B V' with B upper bidiagonal; the singular values of the small B
are those of X, and V times its right singular vectors are the components.

A left vector has an entry per row and stays where its row is. No task keeps it between passes:
U = X (V B^-1), so a row's entries are its products with a small matrix. One pass therefore does a
whole step: each task returns the sums X'w, U'w and w'w of its rows for w = Xv - beta u, and the new
left vector's coefficients, its norm and X'u follow from the totals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import materialize

COMPONENTS = 32
STEP = 64
SEED = 20_240_613
#: Share of the largest singular value below which a norm is rounding and not data.
NOTHING = 1e-13
#: Share below which a component has too few exact digits to be scaled to variance one.
FAINT = 1e-11
BLOCK_ROWS = 2048
_EPS = np.finfo(float).eps
_SAFE = 1 << 62


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: rows without null or non-finite entries, x = floor(64 c) for each entry c.

    A common shift of x changes no result, so none is added. Beyond the range of a long, x stops at its ends.
    """
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    steps = F.transform(v, lambda c: F.floor(c * F.lit(float(STEP))).cast("long"))
    return rows.where(v.isNotNull() & fine & (F.size(v) > 0)).select(
        F.col(id_col).cast("bigint").alias("vec_id"), steps.alias("x")
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in blocks: their ids, and their x as bytes of the narrowest integer that holds all."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(at, BLOCK_ROWS)
            x = some.column("x").flatten().to_numpy(zero_copy_only=False)
            kind = next(
                k
                for k in (np.int16, np.int32, np.int64)
                if np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max
            )
            ids = pa.ListArray.from_arrays(
                pa.array([0, some.num_rows], pa.int32()), some.column("vec_id")
            )
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([x.astype(kind).tobytes()], pa.binary())], names=["ids", "x"]
            )


@dataclass(frozen=True)
class Centre:
    """The mean of the fit list: a whole number and a rest below one for each dimension."""

    n: int
    sums: tuple[int, ...]
    floor: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        floors = [s // n for s in sums]
        rest = [float(Fraction(s - m * n, n)) for s, m in zip(sums, floors)]
        return cls(n, tuple(sums), np.array(floors, dtype=np.int64), np.array(rest))

    def steps(self, ids, raw) -> np.ndarray:
        data, count = raw.as_buffer(), len(ids)
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[data.size // (count * len(self.sums))]
        return np.frombuffer(data, dtype=kind).reshape(count, -1).astype(np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        if max(-int(x.min()), int(x.max())) < _SAFE:
            return (x - self.floor).astype(np.float64) - self.rest
        return x.astype(np.float64) - self.floor.astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond the range of a long."""
        rests = np.array([s - self.n * int(m) for s, m in zip(self.sums, self.floor)], dtype=object)
        if max(-int(x.min()), int(x.max())) < _SAFE:
            far = x - self.floor
            most = self.n * (max(-int(far.min()), int(far.max())) + 1)
            if most * most * x.shape[1] < _SAFE:
                gaps = self.n * far - rests.astype(np.int64)
                return (gaps * gaps).sum(axis=1).tolist()
        gaps = self.n * (x.astype(object) - self.floor.astype(object)) - rests
        found = (gaps * gaps).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in found]


class Vectors:
    """The fit list in the shared folder, in blocks, and sums over its centred rows."""

    def __init__(self, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"):
        good = usable(rows, id_col, vector_col)
        sizes = good.groupBy(F.size("x").alias("width")).count()
        most = sizes.orderBy(F.desc("count"), F.desc("width")).first()
        self.width, self.n = (0, 0) if most is None else (int(most["width"]), int(most["count"]))
        fit = good.where(F.size("x") == self.width)
        self.blocks = materialize(
            fit.mapInArrow(_blocks, "ids array<long>, x binary"), "vector-blocks"
        )
        self.centre = Centre.of(self.n, self._sums()) if self.n else None

    def _sums(self) -> list[int]:
        """Sum of x per dimension, in two halves of a long so that no block overflows."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            plain = Centre(1, (0,) * width, np.zeros(0), np.zeros(0))
            high, low = np.zeros((2, width), dtype=object)
            for batch in batches:
                for ids, raw in zip(batch.column("ids"), batch.column("x")):
                    x = plain.steps(ids, raw)
                    high, low = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
            total = [str((int(h) << 32) + int(k)) for h, k in zip(high, low)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array(total)], names=["place", "total"]
            )

        found = (
            self.blocks.mapInArrow(run, "place int, total string")
            .groupBy("place")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .collect()
        )
        return [int(r["total"]) for r in sorted(found, key=lambda r: r["place"])]

    def totals(self, of, size: int) -> np.ndarray:
        """Sum over all rows of ``of(centred rows)``, ``size`` numbers for each block.

        A task adds up its own blocks, Spark adds up the tasks place by place: the driver gets
        ``size`` numbers whatever the input.
        """
        centre = self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for ids, raw in zip(batch.column("ids"), batch.column("x")):
                    total += of(centre.rows(centre.steps(ids, raw)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array(total)], names=["place", "part"]
            )

        parts = self.blocks.mapInArrow(run, "place int, part double")
        out = np.zeros(size)
        for row in parts.groupBy("place").agg(F.sum("part").alias("total")).collect():
            out[row["place"]] = row["total"]
        return out


@dataclass(frozen=True)
class Spectrum:
    """Unit components as columns, the deviations along them (roots of n e), and n times the trace."""

    components: np.ndarray
    sigma: np.ndarray
    trace: float


def _against(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(vectors: Vectors, wanted: int = COMPONENTS, seed: int = SEED) -> Spectrum:
    """Components of the largest singular values of the centred rows, by one pass a step.

    Ends when the ``wanted`` largest have converged to rounding and the trace leaves no room for
    another one as large, which a repeated eigenvalue could otherwise hide; or when the right vectors span the
    space. Where the recurrence breaks down it goes on from a random direction. The driver holds
    matrices of at most width x width; a task is sent one of width x steps.
    """
    d = vectors.width
    rng = np.random.default_rng(seed)
    right = np.zeros((d, 0))
    images = np.zeros((d, 0))  # X'u of each left vector
    small = np.zeros((0, 0))  # U'XV: upper bidiagonal but for rounding, and for columns without u
    owners: list[int] = []  # the right vector from which each left vector came
    trace = float(vectors.totals(lambda x: np.array([(x * x).sum()]), 1)[0])
    scale, beta = np.sqrt(trace), 0.0
    nxt = None
    while trace > 0 and right.shape[1] < d:
        if nxt is None:
            nxt, beta = _against(rng.standard_normal(d), right), 0.0
            nxt /= np.linalg.norm(nxt)
        count = len(owners)
        left = right[:, owners] @ np.linalg.inv(small[:, owners]) if count else np.zeros((d, 0))
        step = np.column_stack([left, nxt])
        coupled = beta

        def products(x: np.ndarray) -> np.ndarray:
            u = x @ step
            w = u[:, -1] - coupled * u[:, count - 1] if count and coupled else u[:, -1]
            return np.concatenate([x.T @ w, u[:, :-1].T @ w, [w @ w]])

        total = vectors.totals(products, d + count + 1)
        slip = total[d : d + count]
        alpha = np.sqrt(max(total[-1] - slip @ slip, 0.0))
        column = slip.copy()
        if count:
            column[-1] += coupled
        right = np.column_stack([right, nxt])
        small = np.column_stack([small, column])
        residual = None
        if alpha > NOTHING * scale:
            owners.append(right.shape[1] - 1)
            small = np.vstack([small, np.zeros(small.shape[1])])
            small[-1, -1] = alpha
            image = (total[:d] - images @ slip) / alpha
            images = np.column_stack([images, image])
            residual = _against(image, right)
            beta = float(np.linalg.norm(residual))
            nxt = residual / beta if beta > NOTHING * scale else None
        else:
            nxt = None
        p, s, _ = np.linalg.svd(small, full_matrices=False)
        rest = trace - float((s * s).sum())
        open_end = beta if nxt is not None else 0.0
        top = min(wanted, len(s))
        settled = top and (open_end * np.abs(p[-1, :top]) <= 4 * _EPS * scale).all()
        if settled and (rest <= 64 * _EPS * trace or top == wanted and rest < s[top - 1] ** 2):
            break
    _, s, q = np.linalg.svd(small, full_matrices=False)
    keep = int((s[:wanted] > FAINT * scale).sum())
    found = right @ q[:keep].T
    found /= np.linalg.norm(found, axis=0)
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(keep)])
    return Spectrum(found * signs, s[:keep], trace)


def whitened(
    rows: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per usable vector and component: its centred projection over the deviation.

    Vectors that are null, empty, or hold a null or non-finite entry give no rows. All others have one
    length; if a table mixes several, the most frequent is fitted (the longest on a tie) and
    the others give no rows. Repeated rows count and come back as often as they came in, a
    null id comes back as null, other columns are ignored. Directions without variance have no
    component, so a table of one row, or of equal rows, gives none; so does an empty one.
    ``deviation`` is null where it exceeds a long.
    """
    vectors = Vectors(rows, id_col, vector_col)
    schema = (
        f"{id_col} long, component int, n long, deviation long, whitened double,"
        " explained double, identity_error double"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    found = bidiagonalise(vectors, components) if vectors.n else None
    if found is None or not len(found.sigma):
        return rows.sparkSession.createDataFrame([], schema)
    n, centre, k = vectors.n, vectors.centre, len(found.sigma)
    scaled = found.components / (found.sigma / np.sqrt(n))
    explained = found.sigma**2 / found.trace

    def moments(x: np.ndarray) -> np.ndarray:
        z = x @ scaled
        return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0)])

    total = vectors.totals(moments, k * k + k) / n
    covariance = total[: k * k].reshape(k, k) - np.outer(total[k * k :], total[k * k :])
    error = float(np.abs(covariance - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw in zip(batch.column("ids"), batch.column("x")):
                x = centre.steps(ids, raw)
                count = len(x)
                each = pa.array(np.repeat(np.arange(count), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, n)),
                        pa.array(centre.deviations(x), pa.int64()).take(each),
                        pa.array((centre.rows(x) @ scaled).ravel()),
                        pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * k, error)),
                    ],
                    names=names,
                )

    return vectors.blocks.mapInArrow(run, schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all ``embeddings``."""
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
