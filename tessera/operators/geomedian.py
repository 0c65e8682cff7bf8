"""Geometric median of band vectors, solved to a certificate.

The sum of distances f(y) is minimised by Newton steps with a rising damping
where a step does not lower f (a step towards the plain gradient in the end).
f has corners at the observations; the one nearest to the estimate is tried
whenever it changes, and ends the search if the pull of the others on it is not
stronger than its own weight.  At an observation that is not the minimum the
step leaves it along that pull.

Certificate: ``subgradient`` is the length of the least subgradient, zero
exactly at the minimum: |sum of unit vectors| away from the observations, the
excess of the pull over the weight at one.  ``converged`` tells whether the
last Newton step was below ``eps`` (in units of the bands), or the minimum is an
observation.

Observations on one line have a segment of minima if their number is even;
groups solved in one task return its middle, larger ones the point that is
reached from the mean.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.vector_aggregate import group_rows, matrix, states
from tessera.sources.tables import kept

ON = 1e-12       # a pull that exceeds the weight by less counts as equal
BLOCK = 512      # numbers of a block, at most (one vector at least)
HELD = 1 << 22   # numbers a task holds while it packs them into blocks


class State:
    """The searches of some groups as one array; the attributes are views."""

    def __init__(self, table: np.ndarray, b: int):
        self.b, self.table = b, table
        at = 0
        for name, size in (("y", b), ("f", 0), ("r", 0), ("g", b), ("h", b * b), ("w", 0), ("m0", 0), ("trial", b), ("mu", 0), ("tested", b),
                           ("near", b), ("near_d", 0), ("kind", 0), ("step", 0), ("done", 0), ("ok", 0), ("round", 0), ("n", 0)):
            setattr(self, name, table[:, at] if not size else table[:, at:at + size])
            at += size or 1
        self.size = at

    @classmethod
    def start(cls, mean: np.ndarray, n: np.ndarray) -> "State":
        b = mean.shape[1]
        s = cls(np.zeros((len(mean), 6 * b + b * b + 12)), b)
        s.trial[:], s.f[:], s.r[:], s.n[:] = mean, np.inf, np.inf, n
        s.tested[:] = np.nan
        s.y[:] = mean
        return s


def moments(x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Of observations x (groups, points, bands) around y (groups, bands): f,
    sum of 1/d, number at y, gradient, Hessian, distance to and coordinates of
    the nearest observation off y."""
    diff = y[:, None, :] - x
    d = np.sqrt((diff * diff).sum(-1))
    off = mask & (d > 0)
    inv = np.where(off, 1 / np.where(off, d, 1), 0)
    u = diff * inv[..., None]
    h = np.einsum("gp,bc->gbc", inv, np.eye(x.shape[2])) - np.einsum("gp,gpb,gpc->gbc", inv, u, u)
    far = np.where(off, d, np.inf)
    k = far.argmin(1)
    rows = np.arange(len(x))
    return np.concatenate([np.where(mask, d, 0).sum(1)[:, None], inv.sum(1)[:, None], (mask & (d == 0)).sum(1)[:, None],
                           u.sum(1), h.reshape(len(x), x.shape[2] ** 2), far[rows, k][:, None], x[rows, k]], axis=1)


def merge_moments(m: np.ndarray, b: int) -> np.ndarray:
    out = m.sum(0)
    at = 3 + b + b * b
    out[at:] = m[m[:, at].argmin(), at:]
    return out


def advance(s: State, m: np.ndarray, eps: float, max_iter: int) -> None:
    """Take or refuse the trial point by its moments; set the next one."""
    b = s.b
    live = s.done == 0
    f, w, m0, g, h = m[:, 0], m[:, 1], m[:, 2], m[:, 3:3 + b], m[:, 3 + b:3 + b + b * b]
    pull = np.sqrt((g * g).sum(1))
    at = m0 > 0
    r = np.where(at, np.maximum(pull - m0, 0), pull)
    corner = live & at & (pull <= m0 + ON * s.n)
    # Where f is flat to rounding, the slopes along the step tell more: f is
    # convex, so a slope that is not yet positive means that f has fallen.
    path = s.trial - s.y
    before, after = (s.g * path).sum(1), (g * path).sum(1)
    before = np.where(s.m0 > 0, before + s.m0 * np.sqrt((path * path).sum(1)), before)
    with np.errstate(invalid="ignore"):
        falls = (before < 0) & (f <= s.f + 1e-12 * s.f) & ((after <= 0) | (after <= -0.5 * before))
        # An observation is taken only as the minimum: corners are slow to leave.
        lower = ~at & ((f < s.f - 1e-13 * s.f) | falls) | ~np.isfinite(s.f)
    take = live & (corner | lower)
    for name, new in (("f", f), ("r", r), ("g", g), ("h", h), ("w", w), ("m0", m0), ("y", s.trial)):
        old = getattr(s, name)
        old[take] = new[take]
    s.near_d[take], s.near[take] = m[take, 3 + b + b * b], m[take, 4 + b + b * b:]
    newton = s.kind == 0
    scale = np.einsum("gbb->g", s.h.reshape(-1, b, b)) / b
    up, down = live & newton & ~take, live & newton & take
    s.mu[up] = np.minimum(np.maximum(s.mu[up] * 8, 1e-6 * scale[up]), 1e9 * scale[up])
    s.mu[down] = np.where(s.mu[down] < 1e-9 * scale[down], 0, s.mu[down] / 10)
    s.done[corner], s.ok[corner], s.r[corner], s.step[corner] = 1, 1, 0, 0
    s.round[live] += 1
    live = (s.done == 0) & (s.round < max_iter)
    s.done[(s.done == 0) & ~live] = 1
    if not live.any():
        return
    # Try the nearest observation after a Newton step, once.
    fresh = live & (s.kind == 0) & np.isfinite(s.near_d) & ~(s.tested == s.near).all(1)
    s.trial[fresh], s.tested[fresh], s.kind[fresh] = s.near[fresh], s.near[fresh], 1
    rest = np.flatnonzero(live & ~fresh)
    s.kind[rest] = 0
    g, pull = s.g[rest], np.sqrt((s.g[rest] ** 2).sum(1))
    leave = s.m0[rest] > 0
    hess = s.h[rest].reshape(-1, b, b) + s.mu[rest][:, None, None] * np.eye(b)
    move = np.zeros_like(g)
    if (~leave).any():
        try:
            move[~leave] = -np.linalg.solve(hess[~leave], g[~leave][..., None])[..., 0]
        except np.linalg.LinAlgError:
            move[~leave] = -(np.linalg.pinv(hess[~leave]) @ g[~leave][..., None])[..., 0]
    if leave.any():
        size = 0.5 * s.near_d[rest] / (1 + 1e6 * s.mu[rest] / np.maximum(scale[rest], 1e-300)) / np.maximum(pull, 1e-300)
        move[leave] = -size[leave, None] * g[leave]
    move[~np.isfinite(move).all(1)] = 0
    size = np.sqrt((move * move).sum(1))
    s.step[rest] = size
    s.trial[rest] = s.y[rest] + move
    # Newton steps square the error: once one is far below eps, or below what
    # doubles resolve, its end is the answer.
    tiny = ~leave & (s.mu[rest] == 0) & (size <= np.maximum(1e-4 * eps, 4e-15 * np.abs(s.y[rest]).max(1)))
    stuck = ~leave & (size <= 4e-15 * np.abs(s.y[rest]).max(1))
    # A slope of rounding size tells no more of a damped step: it would be
    # taken and refused in turn.  The plain step tells whether y is the answer.
    flat = np.flatnonzero(~leave & (s.mu[rest] > 0) & (pull <= ON * s.n[rest]))
    if len(flat):
        h = s.h[rest[flat]].reshape(-1, b, b)
        plain = np.sqrt(((np.linalg.pinv(h, hermitian=True) @ g[flat][..., None])[..., 0] ** 2).sum(1))
        stuck[flat] |= plain <= 1e-4 * eps
    end = rest[tiny | stuck]
    s.y[end] = s.trial[end]
    s.done[end], s.ok[end] = 1, 1


def on_a_line(x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which groups lie on one line, and the middle of their minima there."""
    n = mask.sum(1)
    mean = np.where(mask[..., None], x, 0).sum(1) / n[:, None]
    c = np.where(mask[..., None], x - mean[:, None], 0)
    _, size, axes = np.linalg.svd(c, full_matrices=False)
    line = (size[:, 1] <= 1e-12 * size[:, 0]) if size.shape[1] > 1 else np.ones(len(x), bool)
    along = np.where(mask, np.einsum("gpb,gb->gp", c, axes[:, 0]), np.inf)
    order = np.argsort(along, axis=1, kind="stable")
    rows = np.arange(len(x))
    # Existing observations, so that nothing is rounded on the way.
    return line, (x[rows, order[rows, (n - 1) // 2]] + x[rows, order[rows, n // 2]]) / 2


def solve(points: list[np.ndarray], eps: float, max_iter: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimates, subgradient lengths, converged of many small groups."""
    b = points[0].shape[1]
    sizes = np.array([len(p) for p in points])
    out, res, ok = np.zeros((len(points), b)), np.zeros(len(points)), np.ones(len(points), bool)
    shape = np.ceil(np.log2(sizes)).astype(int)
    for c in np.unique(shape):
        most = 1 << int(c)                                        # not the largest: sums then do not depend on the neighbours
        some = max(1, (1 << 21) // (most * b * b))                # arrays of about 16 MB
        members = np.flatnonzero(shape == c)
        for at in range(0, len(members), some):
            idx = members[at:at + some]
            x, mask = np.zeros((len(idx), most, b)), np.zeros((len(idx), most), bool)
            for r, i in enumerate(idx):
                x[r, :sizes[i]], mask[r, :sizes[i]] = points[i], True
            line, middle = on_a_line(x, mask)
            out[idx[line]] = middle[line]
            m = moments(x[line], middle[line], mask[line])
            pull = np.sqrt((m[:, 3:3 + b] ** 2).sum(1))
            res[idx[line]] = np.maximum(pull - m[:, 2], 0)
            idx, x, mask = idx[~line], x[~line], mask[~line]
            if not len(idx):
                continue
            s = State.start(np.where(mask[..., None], x, 0).sum(1) / mask.sum(1, keepdims=True), mask.sum(1))
            while True:
                go = np.flatnonzero(s.done == 0)
                if not len(go):
                    break
                part = State(s.table[go], b)
                advance(part, moments(x[go], part.trial, mask[go]), eps, max_iter)
                s.table[go] = part.table
            m = moments(x, s.y, mask)
            pull = np.sqrt((m[:, 3:3 + b] ** 2).sum(1))
            out[idx], ok[idx] = s.y, s.ok > 0
            res[idx] = np.maximum(pull - m[:, 2], 0)
    # Pulls that differ from the weight by rounding only are equal to it.
    return out, np.where(res <= ON * sizes, 0, res), ok


def geomedian(obs: DataFrame, group, bands, eps: float = 5.5e-6, max_iter: int = 500, in_task: int = 4096) -> DataFrame:
    """(group, bands, n_obs, converged, subgradient).  Observations with a
    NULL or NaN band are ignored.  The default ``eps`` is 0.2 steps of int16
    reflectance.

    Groups of up to ``in_task`` observations are solved within one task; of
    larger ones the moments are summed map-side by distributed rounds
    (:mod:`vector_aggregate`), so no large group is ever collected.  Both take
    the same steps."""
    import pyarrow as pa
    group, bands = list(group), list(bands)
    b = len(bands)
    vector = F.array(*[F.col(c).cast("double") for c in bands])
    x = kept(obs.select(*group, vector.alias("_x")).where(F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v))), "vectors")
    types = dict(x.dtypes)
    keys = ", ".join(f"`{g}` {types[g]}" for g in group)
    sizes = x.groupBy(*group).agg(F.count(F.lit(1)).alias("n_obs"))
    few = sizes.where(F.col("n_obs") <= in_task).select(*group)
    many = sizes.where(F.col("n_obs") > in_task)
    result = f"{keys}, _y array<double>, n_obs long, converged boolean, subgradient double"

    def small(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points = [np.array(p, float).reshape(-1, b) for p in batch.column("_p").to_pylist()]
            y, res, ok = solve(points, eps, max_iter)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(g) for g in group), pa.array(y.tolist(), pa.list_(pa.float64())), pa.array([len(p) for p in points], pa.int64()),
                 pa.array(ok), pa.array(res)], names=[*group, "_y", "n_obs", "converged", "subgradient"])
    out = (x.join(few, group, "left_semi").groupBy(*group).agg(F.collect_list("_x").alias("_p")).mapInArrow(small, result))
    if not many.isEmpty():
        large = x.join(many.select(*group), group, "left_semi")
        out = out.unionByName(_by_rounds(kept(packed(large, group, b, keys), "blocks"), group, b, keys, eps, max_iter))
    return out.select(*group, *[F.col("_y")[i].alias(c) for i, c in enumerate(bands)], "n_obs", "converged", "subgradient")


def packed(x: DataFrame, group: list[str], b: int, keys: str) -> DataFrame:
    """Vectors (group, _x) as blocks (group, _p) of one group's vectors each,
    packed by the task that reads them: what is passed over once per round is
    some hundred numbers a row."""
    import pyarrow as pa

    def blocks(batches):
        whole = pa.Table.from_batches(batches).combine_chunks()
        at, found = group_rows(whole, group)
        v = matrix(whole.column("_x").combine_chunks())
        most = max(1, BLOCK // b)
        parts = [(k, v[i[a:a + most]].tobytes()) for k, i in enumerate(at) for a in range(0, len(i), most)]
        out = found.take(pa.array([k for k, _ in parts], pa.int64())).append_column("_p", pa.array([p for _, p in parts], pa.binary()))
        yield from out.combine_chunks().to_batches(max_chunksize=10_000)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows * b
            if n >= HELD:
                yield from blocks(held)
                held, n = [], 0
        if held:
            yield from blocks(held)
    return x.select(*group, "_x").mapInArrow(run, f"{keys}, _p binary")


def _by_rounds(x: DataFrame, group: list[str], b: int, keys: str, eps: float, max_iter: int) -> DataFrame:
    """The searches of large groups, given as blocks: per round one pass over
    the observations of those still searching and one row per group."""
    import pyarrow as pa
    state_of = f"{keys}, _t array<double>"

    def mapped(fn, names):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    table, rest = fn(batch)
                    yield pa.RecordBatch.from_arrays([*(batch.column(g) for g in group), pa.array(table.tolist(), pa.list_(pa.float64())), *rest],
                                                     names=names)
        return run

    def begin(batch):
        m = matrix(batch.column("_s"))
        return State.start(m[:, :b] / m[:, b:], m[:, b]).table, []

    def step(batch):
        s = State(matrix(batch.column("_t")).copy(), b)
        advance(s, matrix(batch.column("_s")), eps, max_iter)
        return s.table, []

    def end(batch):
        s = State(matrix(batch.column("_t")), b)
        res = np.where(s.r <= ON * s.n, 0, s.r)
        return s.y, [pa.array(s.n.astype(np.int64)), pa.array(s.ok > 0), pa.array(res)]

    def vectors(p):
        return np.frombuffer(b"".join(p)).reshape(-1, b)

    def around(p, y):
        v = vectors(p)
        return moments(v[None], y[:1], np.ones((1, len(v)), bool))[0]

    def sums(p):
        v = vectors(p)
        return np.append(v.sum(0), len(v))

    total = states(x, group, ["_p"], sums, lambda s: s.sum(0))
    state = kept(total.mapInArrow(mapped(begin, [*group, "_t"]), state_of), "geomedian")
    place = State(np.arange(6 * b + b * b + 12, dtype=float)[None], b)       # where the parts of a state stand
    over = int(place.done[0])
    finished = None
    while True:
        trial = F.slice("_t", int(place.trial[0, 0]) + 1, b)
        data = x.join(state.select(*group, trial.alias("_y")), group)
        m = states(data, group, ["_p", "_y"], around, lambda s: merge_moments(s, b))
        both = state.join(m, group)
        state = kept(both.mapInArrow(mapped(step, [*group, "_t"]), state_of), "geomedian")
        done = state.where(F.col("_t")[over] > 0)
        finished = done if finished is None else finished.unionByName(done)
        state = state.where(F.col("_t")[over] == 0)
        if state.isEmpty():
            break
    return finished.mapInArrow(mapped(end, [*group, "_y", "n_obs", "converged", "subgradient"]),
                               f"{keys}, _y array<double>, n_obs long, converged boolean, subgradient double")
