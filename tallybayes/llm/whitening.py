"""Embedding whitening: principal directions by a bidiagonal qd solver.

1. *Blockwise QR.* Tasks centre their rows and reduce blocks of them to upper
   triangles, which are stacked and reduced again in tasks, ``FAN`` at a time,
   until one d x d triangle R is left: the covariance is never formed.
2. *Householder bidiagonalisation* turns R into an upper bidiagonal B = U'RV.
3. *dqds* (Fernando and Parlett, "Accurate singular values and differential qd
   algorithms") finds the squared singular values of B without subtractions of
   like numbers, to high relative accuracy. Shifts are Newton steps from zero
   for the characteristic polynomial, which never pass the smallest value; a
   bolder one is tried first and taken back when a pivot turns negative.
4. *Twisted factorisations* (Dhillon and Parlett) of B'B - eI give the
   directions: a top-down and a bottom-up qd factorisation meet where the
   product of the pivots is least, and one solution there is the eigenvector. Values closer than
   ``CLUSTER`` share a cluster, whose vectors come from inverse iterations with
   the same factorisation, each orthogonal to those before.

The rows on the directions, divided by the standard deviation, have covariance
I; ``identity_error`` measures that on all fitted vectors. The driver sees sums
of d numbers, the d x d triangle and that covariance: sizes that don't grow with rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybayes.llm._util import Stage, prepare
from tallybayes.llm.exact_knn import floored

FAN = 16  # triangles that a task reduces to one
BLOCK = 4096  # rows that are reduced at a time
CLUSTER = 1e-4
EPS = np.finfo(np.float64).eps
_SPLIT = 10**15  # sums travel as two longs, as they may not fit one


# -- dense part: one d x d triangle ------------------------------------------------
def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with U'RV upper bidiagonal, by Householder reflections from both sides."""
    a = r.astype(np.float64).copy()
    d = a.shape[1]
    if a.shape[0] < d:
        a = np.vstack([a, np.zeros((d - a.shape[0], d))])
    v = np.eye(d)

    def reflector(x):
        big = np.abs(x).max()
        if big == 0 or not np.any(x[1:]):
            return None
        u = x / big
        u[0] += np.copysign(np.linalg.norm(u), u[0])
        return u / np.linalg.norm(u)

    for k in range(d):
        if (u := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < d - 2 and (u := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _qd(q: list, e: list, shift: float):
    """One differential qd step with a shift: (new q, new e, least d, sum of 1 / d); None if the shift is too large."""
    n = len(q)
    qq, ee = [0.0] * n, [0.0] * (n - 1)
    d, low, inverse = q[0] - shift, np.inf, 0.0
    for k in range(n - 1):
        if d < 0:
            return None
        low, inverse = min(low, d), inverse + (1 / d if d > 0 else np.inf)
        qq[k] = d + e[k]
        if qq[k] > 0:
            ratio = q[k + 1] / qq[k]
            ee[k], d = e[k] * ratio, d * ratio - shift
        else:  # a zero that the rest does not depend on
            ee[k], d = 0.0, q[k + 1] - shift
    if d < 0:
        return None
    qq[n - 1] = d
    return qq, ee, min(low, d), inverse + (1 / d if d > 0 else np.inf)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    big = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if big == 0:
        return np.zeros(len(diagonal))
    q, e = ((diagonal / big) ** 2).tolist(), ((above / big) ** 2).tolist()
    out, total, rounds = [], 0.0, 0
    while q:
        if len(q) == 1:
            out.append(total + q.pop())
            continue
        if e[-1] <= (16 * EPS) ** 2 * (total + q[-1]) or e[-1] == 0:
            out.append(total + q.pop())
            e.pop()
            continue
        if len(q) == 2:  # both at once
            a, b, c = q[0], q[1], e[0]
            s = a + b + c
            high = (s + np.sqrt(max(0.0, (a - b + c) ** 2 + 4 * b * c))) / 2
            out += [total + high, total + (a / high) * b if high > 0 else total]
            break
        if (rounds := rounds + 1) > 200 * (len(diagonal) + 10):
            raise ArithmeticError("dqds does not converge")
        q, e, low, inverse = _qd(q, e, 0.0)
        # the least value is 1 / inverse or more, and no more than low
        safe = 0.0 if np.isinf(inverse) else (1 - 4 * EPS * len(q)) / inverse
        for shift in (max(safe, 0.98 * low), safe):
            if shift > 0 and (step := _qd(q, e, shift)) is not None:
                q, e, total = step[0], step[1], total + shift
                break
    return np.sort(np.array(out))[::-1] * big**2


class Twisted:
    """The factorisations of T - xI, T = B'B, from both ends."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, x: float):
        n = len(diagonal)
        t = diagonal**2
        t[1:] += above**2
        self.off = diagonal[:-1] * above
        tiny = EPS * max(t.max(initial=0), 1e-300)
        # differential forms: s and p are the pivots without the new diagonal entry
        self.low, self.top = np.empty(n), np.empty(n)
        down, up = np.empty(n), np.empty(n)
        s = -x
        for k in range(n):  # top down: pivot = s + b_k^2
            down[k] = s
            self.top[k] = _off_zero(s + diagonal[k] ** 2, tiny)
            if k < n - 1:
                s = above[k] ** 2 * (s / self.top[k]) - x
        p = diagonal[n - 1] ** 2 - x
        for k in range(n - 1, -1, -1):  # bottom up: pivot = p + a_{k-1}^2
            up[k] = p
            self.low[k] = _off_zero(p + (above[k - 1] ** 2 if k else 0.0), tiny)
            if k:
                p = diagonal[k - 1] ** 2 * (p / self.low[k]) - x
        self.pivot = down + up + x
        self.tiny = tiny

    def at_twist(self) -> np.ndarray:
        """The solution of (T - xI) z = pivot * e_r for the r of least pivot, as a unit vector."""
        n, r = len(self.pivot), int(np.abs(self.pivot).argmin())
        z = np.zeros(n)
        z[r] = 1
        for k in range(r - 1, -1, -1):
            z[k] = -self.off[k] / self.top[k] * z[k + 1]
        for k in range(r + 1, n):
            z[k] = -self.off[k - 1] / self.low[k] * z[k - 1]
            if not np.isfinite(z[k]) or abs(z[k]) > 1e150:
                z /= np.abs(z[: k + 1]).max()
        return z / np.linalg.norm(z)

    def solve(self, b: np.ndarray) -> np.ndarray:
        """(T - xI)^-1 b, scaled to length 1."""
        n, r = len(b), int(np.abs(self.pivot).argmin())
        y = b.astype(np.float64).copy()
        for k in range(r):
            y[k + 1] -= self.off[k] / self.top[k] * y[k]
        for k in range(n - 1, r, -1):
            y[k - 1] -= self.off[k - 1] / self.low[k] * y[k]
        z = np.empty(n)
        z[r] = y[r] / _off_zero(self.pivot[r], self.tiny * EPS)
        for k in range(r - 1, -1, -1):
            z[k] = (y[k] - self.off[k] * z[k + 1]) / self.top[k]
        for k in range(r + 1, n):
            z[k] = (y[k] - self.off[k - 1] * z[k - 1]) / self.low[k]
        big = np.abs(z).max()
        return z / big / np.linalg.norm(z / big)


def _off_zero(x: float, tiny: float) -> float:
    return x if abs(x) > tiny * EPS else (-tiny * EPS if x < 0 else tiny * EPS)


def directions(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(all squared singular values of R, falling; the leading unit right vectors as columns).

    There are as many vectors as ``components`` and the rank allow. The sign
    is fixed: the entry of greatest size, the first of equals, is positive.
    """
    d = r.shape[1]
    if d == 0:
        return np.zeros(0), np.zeros((0, 0))
    diagonal, above, v = bidiagonal(r)
    big = max(np.abs(diagonal).max(), np.abs(above).max(initial=0))
    values = dqds(diagonal, above)
    if big == 0:
        return values, np.zeros((d, 0))
    rank = int((values > values[0] * (EPS * d) ** 2 * 16).sum())
    own, over = diagonal / big, above / big
    # entries that round to nothing beside their neighbours split the matrix
    cut = np.abs(over) <= EPS * np.sqrt(np.abs(own[:-1]) * np.abs(own[1:])) * EPS
    over[cut] = 0
    rng = np.random.default_rng(7)
    out, group = [], []
    for k in range(min(components, rank)):
        x = values[k] / big**2
        alone = (k == 0 or values[k - 1] - values[k] > CLUSTER * values[k]) and (
            k + 1 >= d or values[k] - values[k + 1] > CLUSTER * values[k]
        )
        if k == 0 or values[k - 1] - values[k] > CLUSTER * values[k]:
            group = []
        f = Twisted(own, over, x)
        z = f.at_twist()
        if not alone or not np.isfinite(z).all():
            # a shift beside the cluster raises all its directions alike, far above the others
            f, z = Twisted(own, over, x * (1 + 1e-10)), rng.normal(size=d)
            for _ in range(6):
                for g in group * 2:
                    z -= (g @ z) * g
                z = f.solve(z / np.linalg.norm(z))
            for g in group * 2:
                z -= (g @ z) * g
            z /= np.linalg.norm(z)
        group.append(z)
        w = v @ z
        out.append(w * np.sign(w[np.abs(w).argmax()]))
    return values, np.stack(out, axis=1) if out else np.zeros((d, 0))


# -- distributed part ---------------------------------------------------------------
def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in vectors])


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exact sums by (length, position), a row each for a task's rows, in two longs."""
    total: dict[int, np.ndarray] = {}
    count: dict[int, int] = {}
    for batch in batches:
        for d, rows in batch.groupby("dim"):
            x = _matrix(rows["v"])
            # halves keep the sums of a batch within 64 bits
            s = (x >> 32).sum(axis=0).astype(object) * 2**32 + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            total[d] = total.get(d, 0) + s
            count[d] = count.get(d, 0) + len(x)
    for d, s in total.items():
        parts = [divmod(int(v), _SPLIT) for v in s]
        yield pd.DataFrame(
            {"dim": d, "position": np.arange(len(s)), "high": [p[0] for p in parts], "low": [p[1] for p in parts], "n": count[d]}
        ).astype("int64")


def _centred(x: np.ndarray, mean: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - S/n, with S/n as a whole part (exact) and a rest."""
    return (x - mean).astype(np.float64) - rest


def _triangles(means: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, rows in batch.groupby("dim"):
                x = _centred(_matrix(rows["v"]), *means[d])
                held[d] = np.vstack([held[d], x]) if d in held else x
                if len(held[d]) >= max(BLOCK, 2 * d):
                    held[d] = np.linalg.qr(held[d], mode="r")
        for d, a in held.items():
            yield pd.DataFrame({"dim": [d], "r": [np.linalg.qr(a, mode="r").ravel()]})

    return run


def _reduced(rows: pd.DataFrame) -> pd.DataFrame:
    d = int(rows["dim"].iloc[0])
    a = np.vstack([np.asarray(r, np.float64).reshape(-1, d) for r in rows["r"]])
    return pd.DataFrame({"dim": [d], "r": [np.linalg.qr(a, mode="r").ravel()]})


def _moments(means: dict, axes: dict):
    """Sums and products of the whitened rows of a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, rows in batch.groupby("dim"):
                w = _centred(_matrix(rows["v"]), *means[d]) @ axes[d]
                w = np.column_stack([w, np.ones(len(w))])
                total[d] = total.get(d, 0) + w.T @ w
        for d, m in total.items():
            i, j = np.indices(m.shape)
            yield pd.DataFrame({"dim": d, "i": i.ravel(), "j": j.ravel(), "m": m.ravel()})

    return run


def _projected(means: dict, axes: dict, sums: dict, count: dict, facts: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, rows in batch.groupby("dim"):
                x, k = _matrix(rows["v"]), axes[d].shape[1]
                if not k:
                    continue
                w = _centred(x, *means[d]) @ axes[d]
                n, s = count[d], sums[d]
                most = n * int(max(abs(int(x.max())), abs(int(x.min())))) + max(abs(v) for v in s)
                kind = np.int64 if most**2 * d < 2**63 else object
                gap = x.astype(kind) * n - np.array(s, kind)
                dev = (gap * gap).sum(axis=1)
                dev = [int(v) if v < 2**63 else None for v in dev.tolist()]
                explained, error = facts[d]
                yield pd.DataFrame(
                    {
                        "vec_id": np.repeat(rows["vec_id"].array, k),
                        "component": np.tile(np.arange(1, k + 1), len(x)).astype(np.int32),
                        "n": n,
                        "deviation": pd.array(dev, dtype="Int64").repeat(k),
                        "whitened": w.ravel(),
                        "explained": np.tile(explained, len(x)),
                        "identity_error": error,
                    }
                )

    return run


def whiten(rows: DataFrame, components: int = 4, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    The fit takes each distinct vector x = floor(scale * c) once: n of them, S
    their sum by dimension. ``deviation`` is the sum of (n * x - S)^2, exact,
    null where it exceeds a long; ``whitened`` is x - S/n on the component over the
    square root of its eigenvalue; ``explained`` that eigenvalue's share of the
    trace; ``identity_error`` the largest entry of the fitted vectors' whitened
    covariance minus the identity.

    Vectors that are null or empty or hold null or non-finite entries are
    dropped; zero vectors count. Vectors of another length are a fit of their own. There
    are as many components as ``components`` and the rank of the vectors
    allow: none, and so no row, for a single distinct vector. Repeated rows and
    ids, and null ids, have a row each; equal eigenvalues have any orthogonal
    directions. Other columns, whatever they are called, are ignored, and an empty
    table gives an empty result. A task holds blocks of max(4096, 2d) rows, or
    ``FAN`` d x d triangles.
    """
    spark = rows.sparkSession
    prepare(spark)
    stage = Stage(spark, "whitening")
    data = rows.select(F.col("vec_id").cast("long").alias("vec_id"), floored(F.col(vector), scale).alias("v"))
    data = stage.table(data.filter("size(v) > 0").withColumn("dim", F.size("v").cast("long")))
    fit = stage.table(data.groupBy("dim", "v").agg(F.lit(1).alias("one")).drop("one"))

    totals = fit.mapInPandas(_sums, "dim long, position long, high long, low long, n long")
    totals = totals.groupBy("dim", "position").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")])
    sums, count, means = {}, {}, {}
    for r in totals.orderBy("dim", "position").collect():  # a row for each length and position
        sums.setdefault(r["dim"], []).append(int(r["high"]) * _SPLIT + int(r["low"]))
        count[r["dim"]] = int(r["n"])
    for d, s in sums.items():
        whole = [v // count[d] for v in s]
        rest = [(v - w * count[d]) / count[d] for v, w in zip(s, whole, strict=True)]
        means[d] = (np.array(whole, np.int64), np.array(rest))

    # triangles meet FAN at a time
    r = stage.table(fit.mapInPandas(_triangles(means), "dim long, r array<double>").withColumn("g", F.monotonically_increasing_id()))
    tasks = max((row["c"] for row in r.groupBy("dim").agg(F.count("*").alias("c")).collect()), default=0)
    while tasks > 1:
        tasks = -(-tasks // FAN)
        dealt = r.withColumn("g", F.pmod(F.xxhash64("g"), F.lit(tasks)))
        small = dealt.groupBy("dim", "g").applyInPandas(_reduced, "dim long, r array<double>")
        done = r
        r = stage.table(small.withColumn("g", F.monotonically_increasing_id()))
        stage.drop(done)
    axes, shares = {}, {}
    for row in r.collect():  # one d x d triangle for each length
        d = row["dim"]
        values, vectors = directions(np.array(row["r"]).reshape(-1, d), components)
        k = vectors.shape[1]
        axes[d] = vectors / np.sqrt(values[:k] / count[d])
        shares[d] = values[:k] / values.sum() if values.sum() > 0 else values[:k]

    moments = fit.mapInPandas(_moments(means, axes), "dim long, i long, j long, m double")
    moments = moments.groupBy("dim", "i", "j").agg(F.sum("m").alias("m")).collect()
    facts = {}
    for d, share in shares.items():
        k = len(share)
        m = np.zeros((k + 1, k + 1))
        for x in moments:
            if x["dim"] == d:
                m[x["i"], x["j"]] = x["m"]
        mean = m[:k, k] / count[d]
        cov = m[:k, :k] / count[d] - np.outer(mean, mean)
        facts[d] = (share, float(np.abs(cov - np.eye(k)).max(initial=0)))
    stage.drop(fit, r)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return data.mapInPandas(_projected(means, axes, sums, count, facts), schema)
