"""Balancing over puma pools and controlled rounding (SY2-SY4).

Every zone may use every seed household of its puma. Households of a puma with equal incidence
are one *signature*; the dictionary (pool, sig, n, w0, inc) is written once. The weight of
signature s in zone z is never stored; it is a function of the zone's multipliers,

    w(z, s) = min(cap * n_s, share_z * w0_s * exp(sum_c lambda_c(z) * inc_c(s)))

where a multiplier belongs to the constraint's own level (the zone, its TAZ, its region) and
``share_z`` is the zone's household target over the pool's weight. So what a run stores is one
multiplier vector a zone, and what it moves is linear in the dictionary and the zones.

*Soft targets by importance.* A target T with importance I is met up to a relaxation,
achieved = T * (1 - lambda / I), that costs I / (2 T) times the squared miss; the zone's household
total is exact. The dual

    F(lambda) = sum w(z, s) + sum_c T_c * (lambda_c^2 / (2 I_c) - lambda_c)

is strictly convex, so contradictory targets have one compromise, fixed by the importances:
one sum with the targets T1, T2 settles at (I1 + I2) / (I1 / T1 + I2 / T2), up to the pull of the
seed weights. A target of zero counts as ``ZERO``.

*Newton steps on small Hessians.* One pass over the dictionary gives each zone's sums and its K x K
Hessian (numpy matrix products on packed blocks; tasks emit one row a zone, added up by zone).
The system is an arrow: a zone's own multipliers are eliminated inside its TAZ, the TAZ's inside its
region, and the region's few are solved and put back in the same order. The zone's total is kept
by a factor known in closed form. Far-off targets make the problem stiff, so it is solved for a
small part of the importances first and then for ``GROW`` times as much until they are whole. The
driver holds zone-sized arrays only, checked against ``ZONES`` rows.

*Controlled rounding.* The dictionary of a pool is cut into blocks of at most about ``BLOCK``
signatures. Running sums over a zone's blocks, rounded, give every (zone, block) unit a whole number
of households and whole targets for all controls that add up to the zone's. Within the unit the
weights are rounded along a running sum (total exact) and then repaired: units of one signature
are exchanged for another's while that lowers the importance-weighted squared misfit over all
controls, the best exchange among the ``width`` most promising of either side first. Only weights above zero leave the task.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, replace
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popweave.session import materialize

# task functions travel whole, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 16384      # signatures of one rounding unit
ROWS = 2048        # signatures of one matrix product
ZERO = 0.01        # what a target of zero counts as
GROW = 4           # importances of one stage over those of the stage before
ZONES = 20_000     # zones of a run: their Hessians reach the driver (4.5 KB each with 32 constraints)
EVERYONE = -1      # the pool of all households, for zones whose puma has none


@dataclass(frozen=True)
class Zones:
    """The zone dimension at the driver: rows are zones, columns constraints."""
    maz: np.ndarray
    taz: np.ndarray
    region: np.ndarray
    pool: np.ndarray
    households: np.ndarray     # whole household target
    target: np.ndarray         # of each constraint's own level, NaN: none
    importance: np.ndarray     # infinite: exact
    level: tuple[str, ...]
    log_share: np.ndarray
    multiplier: np.ndarray
    cap: float

    def at(self, level: str) -> np.ndarray:
        return np.array([i for i, x in enumerate(self.level) if x == level], np.int64)

    @property
    def has(self) -> np.ndarray:
        return ~np.isnan(self.target)

    @property
    def wanted(self) -> np.ndarray:
        """Targets, zero ones as ``ZERO`` (absent ones: 0)."""
        return np.where(self.has, np.maximum(np.nan_to_num(self.target), ZERO), 0.0)

    def relaxed(self) -> np.ndarray:
        return self.wanted * (1 - self.multiplier / self.importance)

    def once(self, value: np.ndarray) -> float:
        """Sum over zones, a TAZ's and a region's columns taken once."""
        total = value[:, self.at("maz")].sum()
        for level, key in (("taz", self.taz), ("meta", self.region)):
            total += value[np.ix_(np.unique(key, return_index=True)[1], self.at(level))].sum()
        return float(total)


def dictionary(hh_inc: DataFrame, inc: Sequence[str], zone_pumas: DataFrame,
               group: str = "puma") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures, members, zones' pools): the signature table (pool, block, sig, n, w0, inc), each
    household's signature (household_id, pool, sig, n, weight) and (maz, pool).

    A zone's pool is its puma; where the puma has no household, all households (``EVERYONE``)."""
    rows = hh_inc.select("household_id", F.col(group).cast("int").alias("pool"), F.col("weight").cast("double").alias("weight"),
                         F.array(*[F.col(c).cast("int") for c in inc]).alias("inc"))
    held = rows.select("pool").distinct().withColumn("_own", F.lit(True))
    zone_pool = materialize(zone_pumas.select("maz", F.col(group).cast("int").alias("pool")).join(held, "pool", "left")
                            .select("maz", F.when(F.col("_own"), F.col("pool")).otherwise(EVERYONE).alias("pool")), "zone-pools")
    if not zone_pool.filter(F.col("pool") == EVERYONE).isEmpty():
        rows = rows.unionByName(rows.withColumn("pool", F.lit(EVERYONE)))
    sig = materialize(rows.groupBy("pool", "inc").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w0"), F.min("household_id").alias("_first"))
                      .withColumn("sig", F.monotonically_increasing_id()), "signatures")
    blocks = materialize(sig.groupBy("pool").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("_b")), "blocks")  # a row a pool
    table = sig.join(F.broadcast(blocks), "pool").select(
        "pool", F.pmod(F.xxhash64("inc"), F.col("_b")).cast("int").alias("block"), "sig", "n", "w0", "inc")
    # the household of a signature of its own is known from the aggregate; only the others meet their rows again
    alone = sig.filter("n = 1").select(F.col("_first").alias("household_id"), "pool", "sig", "n", F.col("w0").alias("weight"))
    # sorted by a hash of the counts, and merged: small Parquet files don't mean few rows
    hashed = lambda df: df.withColumn("_hash", F.xxhash64("inc"))
    shared = (hashed(rows).join(hashed(sig.filter("n > 1").select("pool", "inc", "sig", "n")).hint("merge"), ["_hash", "pool", "inc"])
              .select("household_id", "pool", "sig", "n", "weight"))
    return table, alone.unionByName(shared), zone_pool


def zones_of(tgt: DataFrame, zone_pool: DataFrame, signatures: DataFrame, constraints, total: int,
             cap: float) -> Zones:
    """The zones with a household target above zero, brought to the driver behind a count."""
    k = len(constraints)
    pooled = signatures.groupBy("pool").agg(F.sum("w0").alias("_w"))
    rows = (tgt.filter(F.round(F.col(f"t_{total}")) > 0).join(zone_pool, "maz").join(F.broadcast(pooled), "pool")
            .select("maz", "taz", "region", "pool", "_w", F.array(*[f"t_{i}" for i in range(k)]).alias("t"))
            .limit(ZONES + 1).toPandas())
    if len(rows) > ZONES:
        raise ValueError(f"more than {ZONES} zones")
    rows = rows.sort_values(["region", "taz", "maz"], ignore_index=True)
    t = np.array([[np.nan if x is None else x for x in r] for r in rows["t"]], float).reshape(-1, k)
    households = np.round(t[:, total]).astype(np.int64)
    column = lambda c: rows[c].to_numpy()
    # a pool whose households all have weight zero is used evenly
    share = np.log(households / np.where(column("_w") > 0, column("_w"), 1.0)) if len(rows) else np.zeros(0)
    return Zones(column("maz"), column("taz"), column("region"), column("pool"), households, t,
                 np.array([c.importance for c in constraints], float), tuple(c.level for c in constraints), share,
                 np.zeros_like(t), float(cap))


def weights(z: Zones, at: np.ndarray, s: np.ndarray, w0: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of signatures ``s`` in the zones ``at`` and the excess of the exponent over the cap."""
    x = s @ z.multiplier[at].T + z.log_share[at]
    over = x - np.log(z.cap * n / w0)[:, None]
    return np.where(over > 0, z.cap * n[:, None], w0[:, None] * np.exp(np.minimum(x, x - over))), np.maximum(over, 0.0)


def _packs(table: pa.Table) -> pa.Table:
    """One row for the signatures of a block: counts of a byte each (wider ones of four), weights and numbers as bytes."""
    inc = table.column("inc").combine_chunks()
    flat = inc.flatten().to_numpy(zero_copy_only=False)
    small = np.abs(flat).max(initial=0) <= np.iinfo(np.int8).max
    whole = lambda c, t: pa.array([np.ascontiguousarray(table.column(c).to_numpy(), t).tobytes()], pa.binary())
    return pa.table({"pool": table.column("pool").slice(0, 1), "block": table.column("block").slice(0, 1), "sig": whole("sig", np.int64),
                     "inc": pa.array([np.ascontiguousarray(flat, np.int8 if small else np.int32).tobytes()], pa.binary()),
                     "w0": whole("w0", np.float64), "n": whole("n", np.int64)})


def packed(signatures: DataFrame) -> DataFrame:
    """The dictionary as the passes read it, (pool, block, sig, inc, w0, n): a row a block, whose signatures stand
    as bytes one after the other, so that Spark moves a few values a block instead of some a signature."""
    if "block" not in signatures.columns:
        signatures = signatures.withColumn("block", F.lit(0))
    n = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (signatures.select("pool", "block", "sig", "inc", "w0", "n").repartition(n, "pool", "block").groupBy("pool", "block")
            .applyInArrow(_packs, "pool int, block int, sig binary, inc binary, w0 binary, n binary"))


def _blocks(batches, k: int):
    """The blocks of ``packed`` rows: (row of its batch, position, pool, sig if read, counts, w0, n)."""
    for batch in batches:
        bytes_of = lambda c, i, t: np.frombuffer(batch.column(c)[i].as_buffer(), t)
        for i, pool in enumerate(batch.column("pool").to_pylist()):
            n = bytes_of("n", i, np.int64)
            data = batch.column("inc")[i].as_buffer()
            s = np.frombuffer(data, np.dtype(f"i{data.size // (len(n) * k)}")).reshape(-1, k)
            sig = bytes_of("sig", i, np.int64) if "sig" in batch.schema.names else None
            yield batch, i, pool, sig, s, np.maximum(bytes_of("w0", i, np.float64), 1e-12), n.astype(float)


def _sums(spread, k: int):
    """Per task and zone: dual part, free and capped weight, component sums, upper half of the Hessian."""
    upper = np.triu_indices(k)

    def run(batches):
        z = Zones(**spread.value)
        where = {p: np.flatnonzero(z.pool == p) for p in np.unique(z.pool)}
        acc: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        space = np.empty((ROWS, k))
        for _, _, p, _, counts, w0, n in _blocks(batches, k):
            if p not in where:
                continue  # no zone uses it
            at = where[p]
            out, hessian = acc.setdefault(p, (np.zeros((len(at), 3 + k)), np.zeros((len(at), k, k))))
            for i in range(0, len(counts), ROWS):
                r = slice(i, i + ROWS)
                s = counts[r].astype(float)
                w, over = weights(z, at, s, w0[r], n[r])
                free = np.where(over > 0, 0.0, w)
                out[:, 0] += (w * (1 + over)).sum(axis=0)
                out[:, 1] += free.sum(axis=0)
                out[:, 2] += (w - free).sum(axis=0)
                out[:, 3:] += w.T @ s
                root, x = np.sqrt(free), space[:len(s)]
                for j in range(len(at)):
                    np.multiply(s, root[:, j:j + 1], out=x)
                    hessian[j] += x.T @ x
        for p, (out, hessian) in acc.items():
            flat = np.concatenate([out, hessian[:, upper[0], upper[1]]], axis=1)
            ends = pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(where[p].astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))],
                                             names=["z", "part"])

    return run


def _added(table: pa.Table) -> pa.Table:
    parts = table.column("part").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    return pa.table({"z": table.column("z").slice(0, 1), "part": pa.array([parts.sum(axis=0).tolist()], pa.list_(pa.float64()))})


def look(signatures: DataFrame, z: Zones) -> np.ndarray:
    """One pass over the dictionary (as it is or ``packed``): a row a zone (dual part, free, capped, sums, Hessian)."""
    k = len(z.level)
    spread = signatures.sparkSession.sparkContext.broadcast(dict(vars(z)))
    table = signatures if dict(signatures.dtypes)["inc"] == "binary" else packed(signatures)
    rows = (table.select("pool", "inc", "w0", "n").mapInArrow(_sums(spread, k), "z int, part array<double>").groupBy("z")
            .applyInArrow(_added, "z int, part array<double>").toArrow())
    spread.unpersist()
    out = np.zeros((len(z.maz), 3 + k + k * (k + 1) // 2))
    if rows.num_rows:
        out[rows.column("z").to_numpy()] = rows.column("part").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    return out


def relaxation_cost(z: Zones) -> float:
    """What the dual adds to the weights' own part: the only one that depends on the importances."""
    return z.once(z.wanted * (z.multiplier ** 2 / (2 * z.importance) - z.multiplier))


def settled(signatures: DataFrame, z: Zones, total: int, tries: int = 6, near: float = 0.05) -> tuple[Zones, float, np.ndarray, np.ndarray]:
    """``z`` with every zone's household total put right by the total's own multiplier, the weights' part of the dual
    there, the sums and the Hessians. Without capped weights one pass is enough: all scales by the same factor."""
    k = len(z.level)
    for left in range(tries - 1, -1, -1):
        part = look(signatures, z)
        dual, free, capped = part[:, :3].T
        sums, hessian = part[:, 3:3 + k], part[:, 3 + k:]
        want = z.households.astype(float)
        off = np.clip(np.log(np.maximum(want - capped, 1e-3 * want)) - np.log(np.maximum(free, 1e-300)), -50, 50)
        if left == 0 or np.abs(off).max(initial=0.0) < near and capped.any():
            break
        multiplier = z.multiplier.copy()
        if not capped.any():
            multiplier[:, total] += off
            z, grow = replace(z, multiplier=multiplier), np.exp(off)
            dual, sums, hessian = dual * grow, sums * grow[:, None], hessian * grow[:, None]
            break
        multiplier[:, total] += np.clip(off, -5, 5)
        z = replace(z, multiplier=multiplier)
    return z, float(dual.sum()), sums, hessian


def newton(z: Zones, sums: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, float]:
    """The Newton step of all multipliers and the largest misfit |achieved - relaxed target| over the
    target. Zones are eliminated inside TAZs, TAZs inside regions."""
    k = len(z.level)
    m, t, r = z.at("maz"), z.at("taz"), z.at("meta")
    o = np.concatenate([t, r])
    # a constraint without target keeps its multiplier at zero
    on, relaxed, scale = z.has.astype(float), z.relaxed(), np.maximum(z.wanted, 1.0)
    curve = np.where(z.has, z.wanted / np.minimum(z.importance, 1e12), 1.0)
    upper, step, misfit = np.triu_indices(k), np.zeros_like(z.multiplier), 0.0

    def cleared(whole, cross, gap, row, columns):
        keep = on[row, columns]
        own = whole * np.outer(keep, keep) + np.diag(curve[row, columns])
        return np.linalg.solve(own, np.column_stack([cross * keep[:, None], gap * keep]))

    def missed(gap, row, columns):
        return np.abs(gap * on[row, columns] / scale[row, columns]).max(initial=0.0)

    for g in np.unique(z.region):
        matrix, side, got, done = np.zeros((len(r), len(r))), np.zeros(len(r)), np.zeros(len(r)), []
        for x in np.unique(z.taz[z.region == g]):
            at = np.flatnonzero((z.region == g) & (z.taz == x))
            whole, rest, solved = np.zeros((len(o), len(o))), np.zeros(len(o)), []
            for i in at:
                h = np.zeros((k, k))
                h[upper] = hessian[i]
                h += np.triu(h, 1).T
                gap = sums[i, m] - relaxed[i, m]
                misfit = max(misfit, missed(gap, i, m))
                cross = h[np.ix_(m, o)] * on[i, m][:, None]
                y = cleared(h[np.ix_(m, m)], cross, gap, i, m)
                whole += h[np.ix_(o, o)] - cross.T @ y[:, :-1]
                rest += sums[i, o] - cross.T @ y[:, -1]
                solved.append(y)
            j, a = at[0], len(t)
            misfit = max(misfit, missed(sums[at][:, t].sum(axis=0) - relaxed[j, t], j, t))
            cross = whole[:a, a:] * on[j, t][:, None]
            y = cleared(whole[:a, :a], cross, rest[:a] - relaxed[j, t], j, t)
            matrix += whole[a:, a:] - cross.T @ y[:, :-1]
            side += rest[a:] - cross.T @ y[:, -1]
            got += sums[at][:, r].sum(axis=0)
            done.append((at, solved, y))
        j = done[0][0][0]
        misfit = max(misfit, missed(got - relaxed[j, r], j, r))
        up = -cleared(matrix, np.zeros((len(r), 0)), side - relaxed[j, r], j, r)[:, -1]
        for at, solved, y in done:
            mid = -y[:, -1] - y[:, :-1] @ up
            rest = np.concatenate([mid, up])
            for i, x in zip(at, solved):
                step[i, m], step[i, t], step[i, r] = -x[:, -1] - x[:, :-1] @ rest, mid, up
    return step, float(misfit)


def solve(signatures: DataFrame, z: Zones, total: int, iterations: int = 100, tolerance: float = 1e-6,
          parts: int = 5, between: float = 0.1) -> tuple[Zones, np.ndarray, list[float]]:
    """Multipliers at the dual's minimum, the zones' sums there and the misfit before each step.

    ``parts`` stages use importances divided by powers of ``GROW`` and stop at the misfit
    ``between``. A step that raises the dual is halved. The weights don't depend on the importances, so a stage
    begins with the sums that the one before ended with. Every pass reads the dictionary table, so
    a lost executor costs its tasks of one pass. A run out of ``iterations`` goes on to the whole
    importances and returns what it has: the history tells."""
    whole, history = np.where(np.arange(len(z.level)) == total, np.inf, z.importance), []
    sums = np.zeros_like(z.multiplier)
    if not len(z.maz):
        return z, sums, history
    if dict(signatures.dtypes)["inc"] != "binary":
        signatures = materialize(packed(signatures), "packed-signatures")
    z, part, sums, hessian = settled(signatures, z, total)
    for stage in range(parts, -1, -1):
        z = replace(z, importance=whole / float(GROW) ** stage)
        while True:
            step, misfit = newton(z, sums, hessian)
            history.append(misfit)
            if misfit <= (tolerance if stage == 0 else between) or len(history) > iterations:
                break
            dual, size = part + relaxation_cost(z), 1.0
            while True:
                trial = settled(signatures, replace(z, multiplier=z.multiplier + size * step), total)
                if trial[1] + relaxation_cost(trial[0]) <= dual + 1e-10 * abs(dual) or size < 1e-3:
                    break
                size /= 2
            z, part, sums, hessian = trial
    return z, sums, history


def achieved(spark, z: Zones, sums: np.ndarray) -> DataFrame:
    """(maz, taz, region, a_0..) of the balanced weights, a row a zone."""
    rows = [(int(z.maz[i]), int(z.taz[i]), int(z.region[i]), *map(float, sums[i])) for i in range(len(z.maz))]
    return spark.createDataFrame(rows, "maz int, taz int, region int, " + ", ".join(f"a_{i} double" for i in range(len(z.level))))


# --- controlled rounding ---------------------------------------------------------------

def rounded(w: np.ndarray, count: int) -> np.ndarray:
    """Whole numbers along the running sum of ``w`` that add up to ``count`` exactly."""
    total = w.sum()
    run = np.cumsum(w / total if total > 0 else np.full(len(w), 1.0 / len(w))) * count
    run[-1] = count
    return np.diff(np.floor(run + 0.5), prepend=0.0).astype(np.int64)


def repair(u: np.ndarray, s: np.ndarray, target: np.ndarray, price: np.ndarray, w: np.ndarray, most: np.ndarray,
           steps: int = 400, width: int = 256) -> np.ndarray:
    """Exchange units between signatures while sum(price * (u @ s - target)^2) falls.

    A step takes the best exchange between the ``width`` signatures whose loss and the ``width`` whose
    gain of a unit is best taken alone; with at most ``width`` signatures that is the best of all. A
    small price on the distance to ``w`` decides between equal ones. The total stays as it is."""
    u, d = u.copy(), u @ s - target
    sq, priced = (s * s) @ price, s * price
    near = 1e-3 * price[price > 0].min(initial=np.inf) if (price > 0).any() else 0.0
    for _ in range(steps):
        g = 2 * (priced @ d)
        gain = np.where(u < most, g + sq + near * (2 * (u - w) + 1), np.inf)
        loss = np.where(u > 0, sq - g + near * (1 - 2 * (u - w)), np.inf)
        i = np.argpartition(loss, width)[:width] if len(u) > width else np.arange(len(u))
        j = np.argpartition(gain, width)[:width] if len(u) > width else np.arange(len(u))
        i, j = i[np.isfinite(loss[i])], j[np.isfinite(gain[j])]
        if not len(i) or not len(j):
            break
        both = loss[i][:, None] + gain[j] - 2 * priced[i] @ s[j].T
        a, b = np.unravel_index(both.argmin(), both.shape)
        # at least half the smallest price: below it only the distance to w would be polished
        if both[a, b] >= -1e-9 * (1 + np.abs(price).max()):
            break
        u[i[a]] -= 1
        u[j[b]] += 1
        d += s[j[b]] - s[i[a]]
    return u


def _block_sums(spread):
    def run(batches):
        z = Zones(**spread.value)
        for batch, i, pool, _, counts, w0, n in _blocks(batches, len(z.level)):
            at = np.flatnonzero(z.pool == pool)
            out = np.zeros((len(at), counts.shape[1] + 1))
            for j in range(0, len(counts), ROWS):
                s = counts[j:j + ROWS].astype(float)
                w, _ = weights(z, at, s, w0[j:j + ROWS], n[j:j + ROWS])
                out[:, :-1] += w.T @ s
                out[:, -1] += w.sum(axis=0)
            same = lambda c: pa.array(np.full(len(at), batch.column(c)[i].as_py()), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), same("pool"), same("block"), pa.array(out.tolist(), pa.list_(pa.float64()))],
                                             names=["z", "pool", "block", "a"])

    return run


def _round_units(spread, steps: int, width: int):
    def run(batches):
        z = Zones(**spread.value)
        for batch, i, _, sig, counts, w0, n in _blocks(batches, len(z.level)):
            s, found = counts.astype(float), [np.zeros((0, 3), np.int64)]
            # by the dearest controls first, so that neighbours of the running sum are alike
            order = np.lexsort((sig, *(s[:, c] for c in np.argsort(z.importance, kind="stable"))))
            s, w0, n, sig = s[order], w0[order], n[order], sig[order]
            for unit in batch.column("units")[i].as_py():
                zone, tau = unit["z"], np.array(unit["tau"])
                w = np.concatenate([weights(z, np.array([zone]), s[j:j + ROWS], w0[j:j + ROWS], n[j:j + ROWS])[0][:, 0]
                                    for j in range(0, len(s), ROWS)])
                w = w * (tau[-1] / w.sum()) if w.sum() > 0 else w
                u = rounded(w, int(tau[-1]))
                price = np.where(z.has[zone] & np.isfinite(z.importance), z.importance / np.maximum(tau[:-1], 1), 0.0)
                u = repair(u, s, tau[:-1].astype(float), price, w, np.maximum(u, np.floor(z.cap * n)), steps, width)
                at = np.flatnonzero(u)
                found.append(np.column_stack([np.full(len(at), zone), sig[at], u[at]]))
            rows = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0], pa.int32()), pa.array(rows[:, 1], pa.int64()), pa.array(rows[:, 2], pa.int64())],
                                             names=["z", "sig", "units"])

    return run


def whole_weights(signatures: DataFrame, z: Zones, steps: int = 400, width: int = 256) -> DataFrame:
    """(maz, sig, units): whole weights above zero; each zone's add up to its household target."""
    spark = signatures.sparkSession
    if not len(z.maz):
        return spark.createDataFrame([], "maz int, sig long, units long")
    spread = spark.sparkContext.broadcast(dict(vars(z)))
    blocks = signatures if dict(signatures.dtypes)["inc"] == "binary" else packed(signatures)
    sums = blocks.mapInArrow(_block_sums(spread), "z int, pool int, block int, a array<double>")
    names = spark.createDataFrame([(i, int(m), int(h)) for i, (m, h) in enumerate(zip(z.maz, z.households))], "z int, maz int, _hh long")
    long = sums.select("z", "pool", "block", F.posexplode("a").alias("c", "x")).join(F.broadcast(names), "z")
    own = Window.partitionBy("z", "c")
    run = F.sum("x").over(own.orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("x").over(own)
    # the last entry counts the households: its running share of the zone's whole target
    share = F.when(total > 0, run / total).otherwise(1.0)
    upto = F.round(F.when(F.col("c") == len(z.level), share * F.col("_hh")).otherwise(run)).cast("long")
    cut = long.withColumn("_upto", upto).withColumn("tau", F.col("_upto") - F.lag("_upto", 1, 0).over(own.orderBy("block")))
    units = (cut.groupBy("z", "pool", "block").agg(F.sort_array(F.collect_list(F.struct("c", "tau"))).alias("t"))
             .select("z", "pool", "block", F.col("t.tau").alias("tau")).filter(F.element_at("tau", -1) > 0)
             .groupBy("pool", "block").agg(F.collect_list(F.struct("z", "tau")).alias("units")))
    found = (blocks.join(units, ["pool", "block"])
             .mapInArrow(_round_units(spread, steps, width), "z int, sig long, units long"))
    return materialize(found.join(F.broadcast(names), "z").select("maz", "sig", "units"), "whole-weights")


@dataclass(frozen=True)
class Balanced:
    """A balanced population: what the loop stores, and its whole weights."""
    signatures: DataFrame   # pool, block, sig, n, w0, inc
    members: DataFrame      # household_id, pool, sig, n, weight
    zones: Zones            # with the multipliers at the optimum
    sums: np.ndarray        # achieved by the fractional weights, zone by constraint
    achieved: DataFrame     # the same as maz, taz, region, a_0..
    units: DataFrame        # maz, sig, units: whole weights above zero
    history: list[float]    # largest misfit before each Newton step


def balance(hh_inc: DataFrame, tgt: DataFrame, zone_pumas: DataFrame, constraints, cfg, iterations: int | None = None,
            tolerance: float = 1e-6, group: str = "puma", parts: int = 5) -> Balanced:
    """Dictionary, multipliers and whole weights (SY2-SY4), in ``parts`` stages before the whole importances. The first household constraint of level
    ``maz`` counts the households: its target is met exactly by the whole weights, and a zone
    without one (or of zero) gets none."""
    total = next(i for i, c in enumerate(constraints) if c.level == "maz" and c.table == "household")
    inc = [f"inc_{c.control}" for c in constraints]
    table, members, zone_pool = dictionary(hh_inc, inc, zone_pumas, group)
    start = zones_of(tgt, zone_pool, table, constraints, total, cfg.max_expansion_factor)
    blocks = materialize(packed(table), "packed-signatures")  # read by every pass
    zones, sums, history = solve(blocks, start, total, cfg.balance_iterations if iterations is None else iterations, tolerance, parts)
    return Balanced(table, members, zones, sums, achieved(table.sparkSession, zones, sums), whole_weights(blocks, zones), history)


def multipliers(spark, z: Zones, constraints) -> DataFrame:
    """(maz, control, level, target, importance, multiplier, relaxation), a row a zone and constraint."""
    relaxation = 1 - z.multiplier / z.importance
    rows = [(int(z.maz[i]), c.control, c.level, float(z.target[i, j]), float(c.importance), float(z.multiplier[i, j]),
             float(relaxation[i, j])) for i in range(len(z.maz)) for j, c in enumerate(constraints) if z.has[i, j]]
    return spark.createDataFrame(rows, "maz int, control string, level string, target double, importance double, "
                                       "multiplier double, relaxation double")


def optimality(spark, z: Zones, sums: np.ndarray, constraints, within: float = 1e-4) -> DataFrame:
    """(level, geo, control, target, settled): does a target hold up to its relaxation, as at the optimum?"""
    keys = {"maz": z.maz, "taz": z.taz, "meta": z.region}
    rows = []
    for j, c in enumerate(constraints):
        geo, first, place = np.unique(keys[c.level], return_index=True, return_inverse=True)
        got = np.bincount(place, sums[:, j], minlength=len(geo))
        for g, i, x in zip(geo, first, got):
            if z.has[i, j]:
                gap = abs(x - z.relaxed()[i, j]) / max(z.target[i, j], 1.0)
                rows.append((c.level, int(g), c.control, float(z.target[i, j]), bool(gap <= within)))
    return spark.createDataFrame(rows, "level string, geo int, control string, target double, settled boolean")
