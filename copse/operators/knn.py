"""k-nearest neighbours as joins (K1-K8).

Exact search over pivot cells
-----------------------------
A few training rows are pivots; every training row belongs to the cell of its
nearest one, and a cell's count and its least and greatest distance from the
pivot are kept (one row a cell). By the triangle inequality no row of a
cell is nearer to a query than ``max(d - greatest, least - d)``, d being the
query's distance from the pivot.

1. Queries are dealt into chunks of bounded bytes, neighbours together. A
   chunk meets the cells that are nearest to its queries, as many as hold k
   rows for each. A query's k-th distance there bounds its final one.
2. It meets every other cell whose bound allows a nearer or equal row for
   one of its queries. No row meets a chunk twice.

A chunk is one group of a join; its training rows stream past it in order of
their id, so a task holds the chunk, the k best rows so far of each query, and
one batch. Training rows are sent once for each chunk that they meet, queries
once. Distances are estimated in single precision (for l2 by a matrix
product) with an error bound, and computed as the SQL fold does for pairs
that may belong to the k best; for l1 they are sums of coordinates in bytes, as
long as few pairs more pass. On vectors without structure the bounds exclude nothing, and
all pairs are compared once; hashing (``lsh_predict``, ``bucketed_predict``)
is for that regime.

Bags (K7) share one search: candidates do not depend on the bag, weights are
joined afterwards, and queries whose bag had too few of them go on with more.

Keys and labels may have any orderable type. Weights: a bag row with
multiplicity w fills up to w neighbour slots. Ties: (distance rounded to 9
places, train id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.functions.argmax import argmax_label
from copse.functions.draws import draw
from copse.plans.broadcast import checked_broadcast
from copse.plans.lineage import cut_lineage
from copse.plans.partitioning import parallelism

#: Rows of a batch that are placed among the pivots at a time.
BLOCK = 2048
#: Queries and training rows of a tile of estimates (4 MB), pairs whose
#: distance is computed at a time, rows of an output batch.
Q_TILE, T_TILE, MERGE, OUT = 256, 4096, 1 << 18, 1 << 16
#: Steps of a coordinate in the estimates for l1, which are sums of bytes; part of all
#: pairs that they may let through before single precision takes over.
LEVELS, LOOSE = 127, 0.02
#: Bytes of the vectors of a chunk of queries.
CHUNK_BYTES = 32 << 20
#: Pivots at most, their bytes at most, and the rows for which one is added.
PIVOTS, PIVOT_BYTES, CELL = 128, 32 << 20, 256


def _required(v: F.Column) -> F.Column:
    total = F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.when(total.isNotNull(), v).otherwise(
        F.raise_error("a point has no features or a NULL among them").cast("array<double>"))


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64, copy=False)


def _pack(x: np.ndarray) -> list[bytes]:
    """A row of a matrix as bytes: single precision where that is exact."""
    with np.errstate(over="ignore"):
        low = x.astype(np.float32)
    exact = (low == x).all(axis=1)
    return [b"f" + f.tobytes() if e else b"d" + d.tobytes() for f, d, e in zip(low, x, exact)]


def _unpack(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    out = [np.frombuffer(r, np.float32 if r[:1] == b"f" else np.float64, offset=1) for r in rows]
    if len({len(x) for x in out}) > 1:
        raise ValueError("vectors of unequal length")
    return np.array(out, np.float64)


def _packed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the vectors ``name`` as bytes."""
    schema = T.StructType([T.StructField(name, T.BinaryType()) if f.name == name else f for f in df.schema.fields])

    def run(batches):
        at = schema.fieldNames().index(name)
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                rows = _pack(_lists(part.column(at)))
                yield part.set_column(at, name, pa.array(rows, pa.binary()))

    return df.mapInArrow(run, schema)


def _lists(column: pa.Array) -> np.ndarray:
    """Matrix of a column of lists of equal length."""
    length = pc.list_value_length(column)
    if len(column) and pc.min_max(length)["min"].as_py() != pc.min_max(length)["max"].as_py():
        raise ValueError("vectors of unequal length")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(column), length[0].as_py() if len(column) else 0)


def _distances(metric: str, q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Left to right over the dimensions, as the SQL fold sums them, so that
    values are bit-identical."""
    if q.shape[1] != t.shape[1]:
        raise ValueError("vectors of unequal length")
    acc = np.zeros((len(q), len(t)))
    for j in range(q.shape[1]):
        d = q[:, j:j + 1] - t[None, :, j]
        acc += np.abs(d) if metric == "l1" else d * d
    return acc if metric == "l1" else np.sqrt(acc)


def _pair_distances(metric: str, q: np.ndarray, t: np.ndarray, qi: np.ndarray, ti: np.ndarray) -> np.ndarray:
    """As ``_distances``, for a list of pairs."""
    acc = np.zeros(len(qi))
    for j in range(q.shape[1]):
        d = q[qi, j] - t[ti, j]
        acc += np.abs(d) if metric == "l1" else d * d
    return acc if metric == "l1" else np.sqrt(acc)


class _Best:
    """The k nearest training rows so far of a chunk of queries, by (rounded
    distance, arrival); training rows arrive by id.

    Estimates in single precision (a matrix product for l2) or, for l1, in
    ``LEVELS`` steps a coordinate, with a proven
    error bound choose the pairs whose distance is computed exactly. ``worst``
    is a distance within which a query has k rows already (NaN: unknown).
    ``cells``: hash cells (queries, tables, projections); only pairs that
    meet in a table, one step in one projection aside, count.
    """

    def __init__(self, metric: str, k: int, q: np.ndarray, worst: np.ndarray, ids: list | None,
                 cells: np.ndarray | None = None):
        self.metric, self.k, self.q, self.cells = metric, k, q, cells
        self.ids = None
        if ids is not None:
            self.ids = {}
            for i, one in enumerate(ids):
                self.ids.setdefault(one, []).append(i)
            if len(self.ids.get(None, ())) > 1:
                del self.ids[None]
        worst = np.where(np.isnan(worst), np.inf, worst)
        self.limit = worst * (1 + 1e-9) + 1e-8
        self.rd = np.full((len(q), k), np.inf)
        self.dist, self.seq = self.rd.copy(), np.full((len(q), k), -1)
        self.seen, self.rows, self.row_seq = 0, [], []
        # Estimates are of centred vectors in units of the largest part.
        self.centre = q.mean(axis=0)
        self.pairs = self.passed = 0
        self.steps = None
        if metric == "l1" and len(q) and 0 < q.shape[1] * LEVELS < 1 << 16:
            low, high = q.min(axis=0), q.max(axis=0)
            step = (high - low).max() / LEVELS
            if np.isfinite(step) and step > 1e-300:
                self.low, self.steps = (low + high) / 2 - step * LEVELS / 2, step
                parts = [self._levels(q[lo:lo + BLOCK]) for lo in range(0, len(q), BLOCK)]
                self.levels, self.missed = (np.concatenate(x) for x in zip(*parts))

    def _levels(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in steps, and by how much a vector's distances in l1 may
        differ for that."""
        level = np.clip(np.rint((x - self.low) / self.steps), 0, LEVELS)
        missed = np.abs(x - (self.low + level * self.steps)).sum(axis=1)
        return level.astype(np.int8), missed * (1 + 1e-9) + 1e-14 * (np.abs(x) + np.abs(self.low)).sum(axis=1)

    def _met(self, cells: np.ndarray, qi, ti) -> np.ndarray:
        return (np.abs(self.cells[qi] - cells[ti]).sum(axis=-1) <= 1).any(axis=-1)

    def _own(self, t_ids: list | None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, training row) of equal ids. Several rows without an id
        are not each other's copies."""
        if self.ids is None:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = [(q, i) for i, t in enumerate(t_ids) for q in self.ids.get(t, ())]
        return tuple(np.array(pairs, np.int64).reshape(-1, 2).T)

    def add(self, t: np.ndarray, t_ids, rows: pa.Table, cells: np.ndarray | None = None) -> None:
        if t.shape[1] != self.q.shape[1]:
            raise ValueError("vectors of unequal length")
        for lo in range(0, len(t), T_TILE):
            hi = min(len(t), lo + T_TILE)
            ids = None if self.ids is None else t_ids[lo:hi]
            own, some = self._own(ids), None if cells is None else cells[lo:hi]
            found = self._near_in_steps(t[lo:hi], own, some)
            qi, ti = self._near(t[lo:hi], own, some) if found is None else found
            self._merge(t[lo:hi], qi, ti, rows.slice(lo, hi - lo))
            self.seen += hi - lo

    def _near_in_steps(self, t, own, cells):
        """As ``_near``, for l1: sums of bytes, two at a time. None where
        steps tell too little: rows far out, or too many pairs let through."""
        if self.steps is None or not np.isfinite(t).all():
            return None
        levels, missed = self._levels(t)
        if missed.max() > self.steps * levels.shape[1]:
            return None
        oq, ot = own
        order = np.argsort(oq, kind="stable")
        oq, ot = oq[order], ot[order]
        of = np.ascontiguousarray(levels.T)
        tile, kk, out = Q_TILE // 4, min(self.k, len(t)), []
        one, two = np.empty((2, tile, len(t)), np.int8)
        total = np.empty((tile, len(t)), np.uint16)
        for a in range(0, len(self.q), tile):
            z = min(len(self.q), a + tile)
            ql, x, y, d = self.levels[a:z], one[:z - a], two[:z - a], total[:z - a]
            d[:] = 0
            for j in range(0, len(of), 2):
                np.subtract(ql[:, j:j + 1], of[j], out=x)
                np.abs(x, out=x)
                if j + 1 < len(of):
                    np.subtract(ql[:, j + 1:j + 2], of[j + 1], out=y)
                    np.abs(y, out=y)
                    np.add(x.view(np.uint8), y.view(np.uint8), out=x.view(np.uint8))
                np.add(d, x.view(np.uint8), out=d)
            error = self.missed[a:z] + missed.max()
            bound = np.minimum(self.limit[a:z], self.rd[a:z, -1] * (1 + 1e-9) + 1e-8)
            lo, hi = np.searchsorted(oq, (a, z))
            mine = oq[lo:hi] - a, ot[lo:hi]
            open_ = np.flatnonzero(~np.isfinite(bound))
            if len(open_):
                part = np.full((z - a, len(t)), np.inf)
                part[open_] = d[open_] * self.steps
                part[mine] = np.inf
                part = part[open_]
                if cells is not None:
                    part[~self._met(cells, (open_ + a)[:, None], np.arange(len(t))[None, :])] = np.inf
                cut = np.partition(part, kk - 1, axis=1)[:, kk - 1]
                # What is rounded to 9 places may tie.
                bound[open_] = (cut + 2 * error[open_]) * (1 + 1e-9) + 1e-8
            top = (bound + error) * (1 + 1e-9) / self.steps
            hit = d <= np.minimum(top, 65535).astype(np.uint16)[:, None]
            hit[mine] = False
            qi, ti = np.divmod(np.flatnonzero(hit), len(t))
            self.pairs, self.passed = self.pairs + d.size, self.passed + len(qi)
            out.append((qi + a, ti))
        if self.seen >= 4 * T_TILE and self.passed > LOOSE * self.pairs:
            self.steps = None
        qi, ti = (np.concatenate(x) for x in zip(*out))
        return (qi, ti) if cells is None else self._in_cells(cells, qi, ti)

    def _in_cells(self, cells, qi, ti):
        met = np.concatenate([np.empty(0, bool)] + [self._met(cells, qi[i:i + 65536], ti[i:i + 65536])
                                                    for i in range(0, len(qi), 65536)])
        return qi[met], ti[met]

    def _near(self, t, own, cells):
        """Pairs that may belong to the nearest."""
        oq, ot = own
        order = np.argsort(oq, kind="stable")
        oq, ot = oq[order], ot[order]
        out = []
        tc = t - self.centre
        scale = max(np.abs(tc).max(initial=0), np.abs(self.q - self.centre).max(initial=0))
        sure = np.isfinite(scale)
        scale = scale if sure and scale > 1e-300 else 1.0
        single = np.float32
        tf = np.ascontiguousarray((tc / scale).astype(single).T)
        l2 = self.metric == "l2"
        tn = (tf * tf).sum(axis=0, dtype=np.float64) if l2 else np.abs(tf).sum(axis=0, dtype=np.float64)
        longest = np.sqrt(tn.max()) if l2 else tn.max()
        tn = tn.astype(single)
        tile = Q_TILE if l2 else Q_TILE // 4
        work = np.empty((2, tile, t.shape[0]), single)
        kk = min(self.k, len(t))
        for a in range(0, len(self.q), tile):
            z = min(len(self.q), a + tile)
            limit = np.minimum(self.limit[a:z], self.rd[a:z, -1] * (1 + 1e-9) + 1e-8)
            lo, hi = np.searchsorted(oq, (a, z))
            mine = oq[lo:hi] - a, ot[lo:hi]
            if not sure:
                d = _distances(self.metric, self.q[a:z], t)
                d[np.isnan(d)] = np.inf
                error = np.zeros(z - a)
                bound = limit
            else:
                qf = ((self.q[a:z] - self.centre) / scale).astype(single)
                d, spare = work[0, :z - a], work[1, :z - a]
                if l2:
                    qn = (qf * qf).sum(axis=1, dtype=np.float64)
                    np.matmul(qf * single(-2), tf, out=d)
                    d += qn.astype(single)[:, None]
                    d += tn
                    reach = (np.sqrt(qn) + longest) ** 2
                    bound = (limit / scale) ** 2
                else:
                    d[:] = 0
                    for j in range(len(tf)):
                        np.subtract(qf[:, j:j + 1], tf[j], out=spare)
                        np.abs(spare, out=spare)
                        np.add(d, spare, out=d)
                    reach = np.abs(qf).sum(axis=1, dtype=np.float64) + longest
                    bound = limit / scale
                # Casts, products and sums: under dim + 8 roundings of 2**-24, taken double.
                error = (len(tf) + 16) * 2.0**-23 * reach + 1e-30
            d[mine] = np.inf
            open_ = np.flatnonzero(~np.isfinite(bound))
            if len(open_):
                part = d[open_]
                if cells is not None:
                    part[~self._met(cells, (open_ + a)[:, None], np.arange(len(t))[None, :])] = np.inf
                cut = np.partition(part, kk - 1, axis=1)[:, kk - 1].astype(np.float64)
                slack = 2 * error[open_] + 1e-7 * np.abs(cut)
                step = 1e-8 / scale
                # What is rounded to 9 places may tie.
                bound = bound.copy()
                root = np.sqrt(np.maximum(cut + slack, 0)) if l2 and sure else cut + slack
                bound[open_] = (root * (1 + 1e-9) + step) ** 2 if l2 and sure else root * (1 + 1e-9) + step
            top = (bound + error) * (1 + 1e-6)
            if sure:
                top = np.minimum(top, 3e38).astype(single)
            qi, ti = np.nonzero((d <= top[:, None]) & (d < np.inf))
            out.append((qi + a, ti))
        qi, ti = (np.concatenate(x) for x in zip(*out))
        return (qi, ti) if cells is None else self._in_cells(cells, qi, ti)

    def _merge(self, t, qi, ti, rows) -> None:
        for lo in range(0, len(qi), MERGE):
            q, i = qi[lo:lo + MERGE], ti[lo:lo + MERGE]
            dist = _pair_distances(self.metric, self.q, t, q, i)
            rd = np.round(dist, 9)
            good = np.isfinite(rd) & (rd <= self.rd[q, -1]) & (dist <= self.limit[q])
            q, i, dist, rd = q[good], i[good], dist[good], rd[good]
            order = np.lexsort((i, rd, q))
            q, i, dist, rd = q[order], i[order], dist[order], rd[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = place < self.k
            q, i, dist, rd, place = q[keep], i[keep], dist[keep], rd[keep], place[keep]
            if not len(q):
                continue
            some, at = np.unique(q, return_inverse=True)
            width = int(place.max()) + 1
            grow = lambda old, new, empty: np.concatenate((old[some], _spread(new, at, place, len(some), width, empty)), axis=1)
            rds, dists = grow(self.rd, rd, np.inf), grow(self.dist, dist, np.inf)
            seqs = grow(self.seq, i + self.seen, -1)
            best = np.lexsort((seqs, rds), axis=1)[:, :self.k]
            self.rd[some], self.dist[some], self.seq[some] = (np.take_along_axis(x, best, 1) for x in (rds, dists, seqs))
            used = np.unique(i)
            self.rows.append(rows.take(pa.array(used)))
            self.row_seq.append(used + self.seen)
        if sum(map(len, self.row_seq)) > 2 * self.seq.size + 65536:
            self._prune()

    def _prune(self) -> None:
        seq, rows = np.concatenate(self.row_seq), pa.concat_tables(self.rows)
        seq, first = np.unique(seq, return_index=True)
        keep = np.isin(seq, self.seq)
        self.row_seq, self.rows = [seq[keep]], [rows.take(pa.array(first[keep])).combine_chunks()]

    def result(self, queries: pa.Table, names: list[str]) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        self._prune()
        seq, rows = self.row_seq[0], self.rows[0]
        qi, place = np.nonzero(self.seq >= 0)
        for lo in range(0, len(qi), OUT):
            q, c = qi[lo:lo + OUT], place[lo:lo + OUT]
            one = queries.take(pa.array(q))
            two = rows.take(pa.array(np.searchsorted(seq, self.seq[q, c])))
            columns = {n: one[n] for n in one.column_names} | {n: two[n] for n in two.column_names}
            columns |= {"dist": pa.array(self.dist[q, c]), "rd": pa.array(self.rd[q, c])}
            yield from pa.table([columns[n] for n in names], names).combine_chunks().to_batches()


def _spread(x: np.ndarray, row: np.ndarray, column: np.ndarray, n: int, width: int, empty) -> np.ndarray:
    out = np.full((n, width), empty, x.dtype)
    out[row, column] = x
    return out


def _kernel(metric: str, exclude_self: bool, k: int, keys: list[str], tables: int):
    """Streams groups of sorted rows: a chunk's queries (side 0), then the
    training rows that it meets (side 1), which are not kept."""
    names = keys + ["q_id", "t_id", "label", "w", "dist", "rd"]

    def hashed(table: pa.Table) -> np.ndarray | None:
        if not tables:
            return None
        return _lists(table["cells"].combine_chunks()).reshape(table.num_rows, tables, -1)

    def begin(parts: list[pa.Table]) -> tuple[_Best, pa.Table]:
        q = pa.concat_tables(parts).combine_chunks()
        ids = q["q_id"].to_pylist() if exclude_self else None
        worst = q["worst"].to_numpy()
        return _Best(metric, k, _unpack(q["feat"].combine_chunks()), worst, ids, hashed(q)), q.select([*keys, "q_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, waiting, best, queries = None, [], None, None
        for b in batches:
            table = pa.Table.from_batches([b])
            g, side = table["g"].to_numpy(), table["side"].to_numpy()
            new = np.flatnonzero((g[1:] != g[:-1]) | (side[1:] != side[:-1])) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(g)]):
                if lo == hi:
                    continue
                if g[lo] != group:
                    if best is not None:
                        yield from best.result(queries, names)
                    group, waiting, best, queries = g[lo], [], None, None
                part = table.slice(lo, hi - lo)
                if side[lo] == 0:
                    waiting.append(part)
                    continue
                if best is None and waiting:
                    (best, queries), waiting = begin(waiting), []
                if best is not None:
                    ids = part["t_id"].to_pylist() if exclude_self else None
                    best.add(_unpack(part["feat"].combine_chunks()), ids, part.select(["t_id", "label", "w"]), hashed(part))
        if best is not None:
            yield from best.result(queries, names)

    return run


def _block_join(t: DataFrame, q: DataFrame, keys: list[str], k: int, metric: str, exclude_self: bool,
                block: int, tables: int = 0) -> DataFrame:
    """(keys, q_id, t_id, label, w, dist, rd): the k best training rows of every
    query on the equi-join on ``keys``.

    A key's queries are split into chunks of some ``block`` rows by a hash;
    all training rows of the key stream past each of them. t: t_feat, q:
    q_feat and worst, in ``_packed`` form; with ``tables``, both have cells."""
    spark = t.sparkSession
    spark.sparkContext.environment.setdefault("OPENBLAS_NUM_THREADS", "1")
    tc = t.groupBy(*keys).count().select(*keys)
    qc = q.groupBy(*[F.col(c).alias(f"k_{c}") for c in keys]).agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    same = F.lit(True)
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"k_{c}"))
    size = cut_lineage(tc.join(qc, same).select(*[f"k_{c}" for c in keys], "chunks", F.monotonically_increasing_id().alias("base")))
    # Numbers of groups: those of a key follow each other, over all keys.
    most = size.agg(F.max("chunks"), F.sum("chunks"), F.count("*")).first()
    stride, total, n_keys = most[0] or 1, int(most[1] or 1), most[2]
    size = checked_broadcast(size)
    vector = lambda side: [F.col(f"{side}_feat").alias("feat"), *([F.col("cells")] if tables else [])]
    own = F.pmod(F.xxhash64("q_id", "q_feat"), F.col("chunks"))
    none = lambda f: F.lit(None).cast(f.dataType).alias(f.name)
    qs, ts = q.join(size, same), t.join(size, same)
    g = lambda c: (F.col("base") * stride + c).alias("g")
    left = qs.select(*keys, g(own), F.lit(0).alias("side"), "q_id", F.col("worst").cast("double").alias("worst"),
                     *[none(t.schema[c]) for c in ("t_id", "label", "w")], *vector("q"))
    right = ts.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        *keys, g(F.col("c")), F.lit(1).alias("side"), none(q.schema["q_id"]), F.lit(None).cast("double").alias("worst"),
        "t_id", "label", "w", *vector("t"))
    rows = left.unionByName(right)
    parts = min(total, max(parallelism(spark), -(-n_keys // 64)))
    if n_keys == 1 or keys == ["chunk"]:
        # Few groups of like size: dealt in turn, where a hash would put several into one task.
        turn = F.col("chunk") if keys == ["chunk"] else F.col("g")
        rows = rows.repartitionById(parts, F.pmod(turn, F.lit(parts)).cast("int"))
    else:
        rows = rows.repartition(max(parallelism(spark), parts), "g")
    rows = rows.sortWithinPartitions("g", "side", "t_id")
    schema = T.StructType([*[t.schema[c] for c in keys], q.schema["q_id"], t.schema["t_id"], t.schema["label"],
                           *T.StructType.fromDDL("w int, dist double, rd double").fields])
    return rows.mapInArrow(_kernel(metric, exclude_self, k, keys, tables), schema)


def _top(pairs: DataFrame, part: list[str], k: int) -> DataFrame:
    """The k best slots of each query, with ``slots``, ``covered`` (slots found)
    and ``worst`` (the last one's distance)."""
    own = Window.partitionBy(*part)
    order = own.orderBy("rd", "t_id")
    # row_number <= k is planned as a partial group limit before the shuffle.
    top = pairs.withColumn("rk", F.row_number().over(order)).where(F.col("rk") <= k)
    before = F.coalesce(F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = top.withColumn("before", before).where(F.col("before") < k) \
        .withColumn("slots", F.least(F.col("w"), F.lit(k) - F.col("before")).cast("int"))
    return top.withColumn("covered", F.sum("slots").over(own)).withColumn("worst", F.max("dist").over(own))


class Cells:
    """Pivots of the training rows and the radii of their cells. The pivots
    (``PIVOT_BYTES`` at most) and one row for each cell reach the driver."""

    def __init__(self, train: DataFrame, metric: str, pivots: int):
        rows = train.select("t_id", "t_feat").orderBy(F.xxhash64("t_id"), "t_id").limit(pivots).collect()
        self.metric = metric
        x = np.array([r.t_feat for r in rows], np.float64)
        self.pivots = x[:max(1, PIVOT_BYTES // max(1, 8 * x.shape[1]))]
        self.rows = cut_lineage(self._nearest(train))
        found = self.rows.groupBy("cell").agg(F.count("*"), F.min("d"), F.max("d")).collect()
        self.count = np.zeros(len(self.pivots), np.int64)
        self.least, self.greatest = np.full(len(self.pivots), np.inf), np.full(len(self.pivots), -np.inf)
        for cell, n, lo, hi in found:
            self.count[cell], self.least[cell], self.greatest[cell] = n, lo, hi

    def _nearest(self, train: DataFrame) -> DataFrame:
        """``train`` with packed vectors, its cell and the distance ``d`` from the pivot."""
        pivots, metric, at = self.pivots, self.metric, train.columns.index("t_feat")
        schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "t_feat" else f for f in train.schema.fields]
                              + T.StructType.fromDDL("cell int, d double").fields)

        def run(batches):
            for b in batches:
                for lo in range(0, b.num_rows, BLOCK):
                    part = b.slice(lo, BLOCK)
                    x = _lists(part.column(at))
                    dist = _distances(metric, x, pivots)
                    columns = [*part.columns, pa.array(dist.argmin(axis=1).astype(np.int32)), pa.array(dist.min(axis=1))]
                    columns[at] = pa.array(_pack(x), pa.binary())
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

        return train.mapInArrow(run, schema)

    def place(self, q: DataFrame, k: int, rows: int) -> DataFrame:
        """(q_id, q_feat packed, near, chunk): the nearest cells that hold k rows,
        and the query's chunk of some ``rows`` queries, neighbours together."""
        pivots, metric, count = self.pivots, self.metric, self.count
        schema = T.StructType([q.schema["q_id"], *T.StructType.fromDDL("q_feat binary, near array<int>").fields])

        def run(batches):
            for b in batches:
                for lo in range(0, b.num_rows, BLOCK):
                    part = b.slice(lo, BLOCK)
                    x = _lists(part.column(1))
                    dist = _distances(metric, x, pivots)
                    order = np.argsort(np.where(count > 0, dist, np.inf), axis=1, kind="stable")
                    held = np.cumsum(count[order], axis=1) - count[order]
                    take = (held < k) & (count[order] > 0)
                    near = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(take.sum(axis=1))).astype(np.int32)),
                                                    pa.array(order[take].astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_pack(x), pa.binary()), near], schema.names)

        placed = cut_lineage(q.select("q_id", "q_feat").mapInArrow(run, schema))
        first = F.element_at("near", 1)
        n = dict(placed.groupBy(first).count().collect())
        start, size, done = [0] * len(pivots), [1] * len(pivots), 0
        for cell in self._line():
            start[cell], size[cell] = done, max(1, n.get(cell, 0))
            done += n.get(cell, 0)
        of = lambda xs: F.element_at(F.array(*[F.lit(x).cast("long") for x in xs]), first + 1)
        at = of(start) + F.pmod(F.xxhash64("q_id", "q_feat"), of(size))
        return placed.withColumn("chunk", F.floor(at / F.lit(rows)).cast("long"))

    def _line(self) -> list[int]:
        """The cells in an order in which neighbours tend to follow each other."""
        dist = _distances(self.metric, self.pivots, self.pivots)
        line, left = [0], np.ones(len(dist), bool)
        left[0] = False
        while left.any():
            line.append(int(np.where(left, dist[line[-1]], np.inf).argmin()) if np.isfinite(dist[line[-1]][left]).any()
                        else int(np.flatnonzero(left)[0]))
            left[line[-1]] = False
        return line

    def further(self, q: DataFrame) -> DataFrame:
        """(chunk, cell): the cells that can hold a row as near as the k-th so far
        (``worst``; none: any) of a query of the chunk."""
        pivots, metric, count, least, greatest = self.pivots, self.metric, self.count, self.least, self.greatest

        def run(batches):
            seen = set()
            for b in batches:
                for lo in range(0, b.num_rows, BLOCK):
                    part = b.slice(lo, BLOCK)
                    dist = _distances(metric, _unpack(part.column(0)), pivots)
                    bound = np.maximum(dist - greatest, least - dist)
                    worst = part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                    worst = np.where(np.isnan(worst), np.inf, worst)
                    # Slack for the rounding of distances to 9 places and of sums.
                    row, cell = np.nonzero(~(bound > worst[:, None] * (1 + 1e-9) + 1e-8) & (count > 0))
                    pairs = set(zip(part.column(1).to_numpy()[row].tolist(), cell.tolist())) - seen
                    seen |= pairs
                    if pairs:
                        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], t) for i, t in
                                                          enumerate((pa.int64(), pa.int32()))], ["chunk", "cell"])

        return q.select("q_feat", "chunk", "worst").mapInArrow(run, "chunk long, cell int").distinct()

    def meeting(self, needs: DataFrame) -> DataFrame:
        """The training rows for every chunk that needs their cell."""
        chunks = F.broadcast(needs.groupBy("cell").agg(F.collect_set("chunk").alias("chunks")))
        return self.rows.drop("d").join(chunks, "cell").withColumn("chunk", F.explode("chunks")).drop("cell", "chunks")


def search(train: DataFrame, query: DataFrame, k: int, metric: str = "l2",
           within: tuple[str, ...] | list[str] = (), exclude_self: bool = False,
           pivots: int | None = None) -> DataFrame:
    """Exact top-k neighbours.

    train: (row_id, label, features[, w][, *within])
    query: (row_id, features[, *within])
    returns (*within, q_id, t_id, label, dist, slots): at most k slots per
    (within, q_id); ``slots`` is how many of the k places the row fills.

    With ``within``, a query meets all training rows of its group, in chunks;
    without, pivot cells exclude rows (``pivots`` of them, by default one
    for ``CELL`` training rows, ``PIVOTS`` at most).
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if metric not in ("l1", "l2"):
        raise ValueError(f"unknown metric {metric!r}; use 'l1' or 'l2'")
    within = list(within)
    t, q = _sides(train, query, within)
    n = t.count()
    block = _chunk(query)
    out = within + ["q_id", "t_id", "label", "dist", "slots"]
    unbound = F.lit(None).cast("double")
    if within or not n:
        keys = within or ["cell"]
        t, q = (_packed(df if within else df.withColumn("cell", F.lit(0)), f"{side}_feat") for df, side in ((t, "t"), (q, "q")))
        return _top(_block_join(t, q.withColumn("worst", unbound), keys, k, metric, exclude_self, block), within + ["q_id"], k) \
            .select(*out)
    cells = Cells(t, metric, pivots or max(1, min(PIVOTS, n // CELL)))
    kept = ["q_id", "t_id", "label", "w", "dist", "rd"]
    # A chunk is not cut again.
    join = lambda needs, part: _block_join(cells.meeting(needs), part, ["chunk"], k, metric, exclude_self, 1 << 40) \
        .select(*kept)
    placed = cells.place(q, k + exclude_self, block)
    near = cut_lineage(placed.select("chunk", F.explode("near").alias("cell")).distinct())
    pairs = join(near, placed.drop("near").withColumn("worst", unbound))
    if len(cells.pivots) == 1:
        return _top(pairs, ["q_id"], k).select(*out)
    first = cut_lineage(_top(pairs, ["q_id"], k).select(*kept, "covered", "worst"))
    bound = first.groupBy("q_id").agg(F.max(F.when(F.col("covered") >= k, F.col("worst"))).alias("worst"))
    placed = cut_lineage(placed.drop("near").join(bound, "q_id", "left"))
    needs = cut_lineage(cells.further(placed).join(near, ["chunk", "cell"], "left_anti"))
    return _top(first.select(*kept).unionByName(join(needs, placed)), ["q_id"], k).select(*out)


def _sides(train: DataFrame, query: DataFrame, more: list[str]) -> tuple[DataFrame, DataFrame]:
    t = train.select(*more, F.col("row_id").alias("t_id"), "label", _required(F.col("features")).alias("t_feat"),
                     (F.col("w") if "w" in train.columns else F.lit(1)).cast("int").alias("w"))
    return t, query.select(*more, F.col("row_id").alias("q_id"), _required(F.col("features")).alias("q_feat"))


def _chunk(query: DataFrame) -> int:
    """Queries of a chunk: two chunks for each core while a chunk's vectors
    stay within ``CHUNK_BYTES``."""
    n, width = query.agg(F.count("*"), F.max(F.size("features"))).first()
    return max(64, min(-(-n // (2 * query.sparkSession.sparkContext.defaultParallelism)), CHUNK_BYTES // max(1, 8 * (width or 1))))


def vote(neighbours: DataFrame, within: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """K4: majority label over each query's neighbour slots (ties: smallest label)."""
    within = list(within)
    counts = neighbours.groupBy(*within, "q_id", "label").agg(F.sum("slots").alias("n"))
    return counts.groupBy(*within, "q_id").agg(argmax_label("label", "n").alias("pred"))


def predict(train: DataFrame, query: DataFrame, k: int, metric: str = "l2",
            within: tuple[str, ...] | list[str] = (), exclude_self: bool = False,
            pivots: int | None = None) -> DataFrame:
    """K3 + K4 with a left join back to the queries, so a query with no
    neighbour (empty bucket) gets a NULL prediction: (*within, row_id, pred)."""
    within = list(within)
    nb = search(train, query, k, metric, within, exclude_self, pivots)
    votes = vote(nb, within).withColumnRenamed("q_id", "row_id")
    return query.select(*within, "row_id").join(votes, within + ["row_id"], "left")


def grid_bucket(features: str | F.Column, cell: float, metric: str = "l1") -> F.Column:
    """K5: bucket key from a grid over the fixed projection sum(x) (rounded
    to 6 places so both engines agree at cell edges). Points in one bucket
    are near along that projection, unlike a hash of components."""
    v = F.col(features) if isinstance(features, str) else features
    total = F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.floor(F.round(total, 6) / F.lit(float(cell))).cast("bigint")


def bucketed_predict(train: DataFrame, query: DataFrame, k: int, cell: float,
                     metric: str = "l1", exclude_self: bool = False) -> DataFrame:
    """K6: search only the query's own bucket (exactly, in
    blocks); a query whose bucket holds no training row gets NULL."""
    tb = train.withColumn("bucket", grid_bucket("features", cell))
    qb = query.withColumn("bucket", grid_bucket("features", cell))
    out = predict(tb, qb, k, metric, within=["bucket"], exclude_self=exclude_self)
    return out.drop("bucket")


def bagged_predict(bag: DataFrame, query: DataFrame, k: int, metric: str = "l2",
                   n_models: int | None = None, exclude_self: bool = False, first_model: int = 0,
                   spare: int = 6) -> DataFrame:
    """K7: per-bag k-NN vote for every query, (model_id, row_id, pred), for the
    ``n_models`` models from ``first_model`` on.

    ``bag`` is (model_id, row_id, w, label, features). One search finds the
    ``spare * k`` nearest of all rows that any bag has; their weights are joined
    afterwards. Where a bag has fewer than k slots among them, the query goes
    on with ``spare`` times as many, until every bag has k or no row is left.
    """
    if n_models is None:
        n_models = bag.agg(F.max("model_id")).first()[0] + 1 - first_model
    weights = cut_lineage(bag.groupBy("row_id", "model_id").agg(F.sum("w").cast("int").alias("w"))
                          .select(F.col("row_id").alias("t_id"), "model_id", "w"))
    base = cut_lineage(bag.groupBy("row_id").agg(F.first("label").alias("label"), F.first("features").alias("features")))
    n = base.count()
    models = F.explode(F.sequence(F.lit(first_model), F.lit(first_model + n_models - 1)))
    todo = cut_lineage(query.select("row_id", "features"))
    each = todo.select("row_id", models.alias("model_id"))
    done, size = None, spare * k
    while True:
        found = cut_lineage(search(base, todo, size, metric, exclude_self=exclude_self))
        ranked = found.drop("slots").join(weights, "t_id").withColumn("rd", F.round("dist", 9))
        top = cut_lineage(_top(ranked, ["model_id", "q_id"], k).select("model_id", "q_id", "label", "slots", "covered"))
        if size >= n:
            done = top if done is None else done.unionByName(top)
            break
        full = top.where(F.col("covered") >= k).groupBy("q_id").agg(F.count_distinct("model_id").alias("m")) \
            .where(F.col("m") == n_models).select(F.col("q_id").alias("row_id"))
        left = cut_lineage(todo.join(full, "row_id", "left_anti"))
        final = top.join(left.select(F.col("row_id").alias("q_id")), "q_id", "left_anti").select(top.columns)
        done = final if done is None else done.unionByName(final)
        if left.isEmpty():
            break
        todo, size = left, spare * size
    votes = vote(done, ["model_id"]).withColumnRenamed("q_id", "row_id")
    return each.join(votes.withColumn("model_id", F.col("model_id").cast("int")), ["model_id", "row_id"], "left") \
        .select("model_id", "row_id", "pred")


def lsh_cells(features: str | F.Column, tables: int, projections: int, width: float, dim: int, seed: int) -> list[list[F.Column]]:
    """For every table, the cells of ``projections`` random projections
    (coefficients 1 or -1, drawn by md5)."""
    v = F.col(features) if isinstance(features, str) else features
    out = []
    for j in range(tables):
        cells = []
        for p in range(projections):
            signs = F.lit([1.0 if draw(seed, j * projections + p, i) < 0.5 else -1.0 for i in range(dim)])
            total = F.aggregate(F.zip_with(v, signs, lambda x, s: x * s), F.lit(0.0).cast("double"), lambda acc, x: acc + x)
            cells.append(F.floor(F.round(total, 6) / F.lit(float(width))).cast("long"))
        out.append(cells)
    return out


def lsh_keys(features: str | F.Column, tables: int, projections: int, width: float, dim: int, seed: int,
             probe: bool = False) -> F.Column:
    """Array of (table, key) of ``lsh_cells``. With ``probe``, also the keys that
    differ by one step in one projection."""
    return _table_keys(lsh_cells(features, tables, projections, width, dim, seed), probe)


def _table_keys(tables: list[list[F.Column]], probe: bool) -> F.Column:
    out = []
    for j, cells in enumerate(tables):
        steps = [[0] * len(cells)]
        if probe:
            steps += [[d if i == p else 0 for i in range(len(cells))] for p in range(len(cells)) for d in (-1, 1)]
        out += [F.struct(F.lit(j).alias("table"), F.concat_ws(",", *[(c + F.lit(d)).cast("string") for c, d in zip(cells, s)])
                         .alias("key")) for s in steps]
    return F.array(*out)


def lsh_predict(train: DataFrame, query: DataFrame, k: int, tables: int, projections: int, width: float, dim: int,
                seed: int, metric: str = "l2", exclude_self: bool = False) -> DataFrame:
    """K6 with several hash tables: a query probes its cell and the
    neighbouring ones of every table; candidates that share several cells
    with it are taken once. A query without candidates gets NULL.

    The pairs that meet are counted first, over all tables. Where there are
    fewer than queries times training rows, or training ids repeat, each cell
    is searched; else the training rows stream past the queries once, with
    their cells, and only pairs that meet in a table count, so none is
    compared for each table."""
    flat = [c for cells in lsh_cells("features", tables, projections, width, dim, seed) for c in cells]
    t = cut_lineage(train.select("row_id", "label", "features", F.array(*flat).alias("cells")))
    q = t.select("row_id", "features", "cells") if query is train else \
        cut_lineage(query.select("row_id", "features", F.array(*flat).alias("cells")))
    parts = [[F.get("cells", j * projections + p) for p in range(projections)] for j in range(tables)]
    keyed = lambda df, probe: df.withColumn("cell", F.explode(_table_keys(parts, probe))).withColumn(
        "table", F.col("cell.table")).withColumn("key", F.col("cell.key")).drop("cell", "cells")
    repeated = not t.groupBy("row_id").count().where("count > 1").isEmpty()
    if repeated or _meetings(keyed(t, False), keyed(q, True)) < t.count() * q.count():
        found = search(keyed(t, False), keyed(q, True), k, metric, within=["table", "key"], exclude_self=exclude_self)
    else:
        ts, qs = (_packed(df.withColumn("every", F.lit(0)), f) for df, f in zip(
            _sides(t, q, ["cells"]), ("t_feat", "q_feat")))
        found = _block_join(ts, qs.withColumn("worst", F.lit(None).cast("double")), ["every"], k, metric, exclude_self,
                            _chunk(query), tables)
    once = found.groupBy("q_id", "t_id").agg(F.first("label").alias("label"), F.first("dist").alias("dist"))
    top = _top(once.withColumn("w", F.lit(1)).withColumn("rd", F.round("dist", 9)), ["q_id"], k)
    return query.select("row_id").join(vote(top).withColumnRenamed("q_id", "row_id"), "row_id", "left")


def _meetings(t: DataFrame, q: DataFrame) -> float:
    """Pairs of rows that meet under a table's key, counted for every such key."""
    of = lambda df, n: df.groupBy("table", "key").agg(F.count("*").cast("double").alias(n))
    return of(t, "nt").join(of(q, "nq"), ["table", "key"]).agg(F.sum(F.col("nt") * F.col("nq"))).first()[0] or 0.0
