"""k-means under three criteria (SSE, I2, E1) with repeated trials.

Layout. Documents stay in long form ``(id, dim, w)``, hash-partitioned by ``id``.
Centroids are one row per dimension with one column per (trial, cluster), so a pass is
one join on ``dim`` and one aggregate by ``id`` that scores every cluster of every
trial at once, without a cross join and without moving a document. The centroid table
is read back from the scratch folder with its true size: Spark broadcasts it while it
is below the session's threshold and falls back to a shuffle join beyond.

Per cluster only scalars reach the driver: size, squared norm, dot with the corpus
vector, and the shift of the last pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from orevein.functions.hashing import digest
from orevein.operators import vectors as V
from orevein.session import Scratch, materialize

CRITERIA = ("SSE", "I2", "E1")
SHIFT_LIMIT = 0.01  # fixed value: mean centroid change below which a trial has converged
MAX_SCORES = 64  # scores per document and pass; more trials than that run in batches
THINNEST = 12  # E1 moves are thinned to a share of 2**-12 before a single document is tried
SCORE_DIGITS = 9  # similarities are compared at this precision, ties go to the lowest cluster


def seeds(vectors: DataFrame, k: int, trials: int = 1) -> DataFrame:
    """``(trial, k, id)``: per trial the ``k`` documents that come first in hash order."""
    order = Window.partitionBy("trial").orderBy(digest(F.col("id"), F.col("trial")), "id")
    # The rank filter is pushed below the shuffle, so each task ships at most k rows a trial.
    return (
        vectors.select("id").distinct()
        .select("id", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))).alias("trial"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k)
        .select("trial", (F.col("place") - 1).alias("k"), "id")
    )


def centroid(t: int, j: int) -> str:
    return f"c_{t}_{j}"


def _sums(member: str, keys: list[tuple[int, int]]) -> list[Column]:
    """One conditional sum of weights per (trial, cluster)."""
    return [F.expr(f"sum(CASE WHEN {member.format(t=t, j=j)} THEN w ELSE 0D END) AS {centroid(t, j)}") for t, j in keys]


def seed_centroids(vectors: DataFrame, seed: DataFrame, k: int, trials: range) -> DataFrame:
    """Wide centroids ``(dim, c_t_j ...)`` that equal the seed documents."""
    keys = [(t, j) for t in trials for j in range(k)]
    return vectors.join(seed, "id").groupBy("dim").agg(*_sums("trial = {t} AND k = {j}", keys))


def composites(vectors: DataFrame, assigned: DataFrame, k: int, trials: list[int]) -> DataFrame:
    """Wide sums of the member vectors; a hot dimension is combined before the shuffle."""
    keys = [(t, j) for t in trials for j in range(k)]
    return vectors.join(assigned, "id").groupBy("dim").agg(*_sums("k_{t} = {j}", keys))


def cluster_sizes(assigned: DataFrame, k: int, trials: list[int]) -> dict[tuple[int, int], int]:
    keys = [(t, j) for t in trials for j in range(k)]
    row = assigned.agg(*[F.expr(f"count_if(k_{t} = {j}) AS {centroid(t, j)}") for t, j in keys]).first()
    return {(t, j): row[centroid(t, j)] for t, j in keys}


@dataclass
class Stats:
    """Scalars of one centroid: members, squared norm of the sum, dot with the corpus vector."""

    n: int
    norm2: float
    dot_total: float = 0.0

    @property
    def norm(self) -> float:
        return self.norm2 ** 0.5


def with_corpus(wide: DataFrame, corpus: DataFrame | None) -> DataFrame:
    """Add the corpus vector as column ``total_w``; it covers every dimension there is."""
    if corpus is None:
        return wide
    return corpus.select("dim", F.col("w").alias("total_w")).join(wide, "dim", "left").na.fill(0.0)


def _stat_sums(wide: DataFrame, keys: list[tuple[int, int]]) -> list[Column]:
    sums = [F.expr(f"sum({centroid(t, j)} * {centroid(t, j)}) AS q_{t}_{j}") for t, j in keys]
    if "total_w" in wide.columns:
        sums += [F.expr(f"sum({centroid(t, j)} * total_w) AS s_{t}_{j}") for t, j in keys]
    return sums


def _to_stats(row: dict, sizes: dict[tuple[int, int], int]) -> dict[tuple[int, int], Stats]:
    return {
        (t, j): Stats(n, row[f"q_{t}_{j}"] or 0.0, row.get(f"s_{t}_{j}") or 0.0) for (t, j), n in sizes.items()
    }


def cluster_stats(wide: DataFrame, sizes: dict[tuple[int, int], int]) -> dict[tuple[int, int], Stats]:
    """One row of scalars over the centroid table."""
    return _to_stats(wide.agg(*_stat_sums(wide, list(sizes))).first().asDict(), sizes)


def stats_and_shift(
    criterion: str, old: DataFrame, new: DataFrame,
    old_stats: dict[tuple[int, int], Stats], sizes: dict[tuple[int, int], int],
) -> tuple[dict[tuple[int, int], Stats], dict[int, float]]:
    """Scalars of the new centroids, and the mean centroid change per trial.

    The change is the L2 distance of the means for SSE, else 1 - cosine. Old and new
    centroids are joined by dimension once; one row reaches the driver.
    """
    names = [centroid(t, j) for t, j in sizes]
    before = old.select("dim", *[F.col(c).alias(f"old_{c}") for c in names])
    both = new.join(before, "dim", "full").na.fill(0.0)
    sums = _stat_sums(new, list(sizes))
    for (t, j), n in sizes.items():
        c = centroid(t, j)
        if criterion == "SSE":
            change = f"({c} / {float(n)!r}D - old_{c} / {float(old_stats[t, j].n)!r}D)"
            sums.append(F.expr(f"sum({change} * {change}) AS x_{t}_{j}"))
        else:
            sums.append(F.expr(f"sum({c} * old_{c}) AS x_{t}_{j}"))
    row = both.agg(*sums).first().asDict()
    stats = _to_stats(row, sizes)
    changes: dict[int, list[float]] = {}
    for (t, j), s in stats.items():
        value = row[f"x_{t}_{j}"] or 0.0
        if criterion == "SSE":
            change = max(value, 0.0) ** 0.5
        else:
            norms = s.norm * old_stats[t, j].norm
            change = 1 - value / norms if norms else 0.0
        changes.setdefault(t, []).append(change)
    return stats, {t: sum(c) / len(c) for t, c in changes.items()}


def dots(vectors: DataFrame, wide: DataFrame, keys: list[tuple[int, int]]) -> DataFrame:
    """``(id, p_t_j ...[, p_total])``: dot product of every document with every centroid.

    Documents that share no dimension with a centroid score 0. ``own`` is the document's squared length.
    """
    products = [F.expr(f"sum(w * coalesce({centroid(t, j)}, 0D)) AS p_{t}_{j}") for t, j in keys]
    products.append(F.expr("sum(w * w) AS own"))
    if "total_w" in wide.columns:
        products.append(F.expr("sum(w * coalesce(total_w, 0D)) AS p_total"))
    return vectors.join(wide, "dim", "left").groupBy("id").agg(*products)


# Scores are SQL text: ``p`` is the document's dot product with the composite of a cluster.


def cosine(p: str, s: Stats) -> str:
    """Cosine of a document and a centroid, 0 for an empty centroid or a zero document."""
    return f"coalesce({p} / nullif(sqrt(own) * {s.norm!r}D, 0D), 0D)" if s.norm > 0 else "0D"


def squared_distance(p: str, s: Stats) -> str:
    """Squared distance of a document and the cluster mean."""
    return f"own - 2D * {p} / {float(s.n)!r}D + {s.norm2 / s.n**2!r}D"


def l2_similarity(p: str, s: Stats) -> str:
    return f"-sqrt(greatest({squared_distance(p, s)}, 0D))"


def separation(p: str, p_total: str, s: Stats, inside: str) -> str:
    """Change of the E1 objective when the document joins the cluster (or stays in it)."""
    n, norm2, dot = f"{float(s.n)!r}D", f"{s.norm2!r}D", f"({s.dot_total!r}D)"
    now = f"{s.n * s.dot_total / s.norm!r}D" if s.norm2 > 0 else "0D"
    joined = f"sqrt({norm2} + 2D * {p} + own)"
    add = f"coalesce(({n} + 1D) * ({dot} + {p_total}) / nullif({joined}, 0D), 0D) - ({now})"
    left = f"sqrt(greatest({norm2} - 2D * {p} + own, 0D))"
    without = f"coalesce(({n} - 1D) * ({dot} - {p_total}) / nullif({left}, 0D), 0D)" if s.n > 1 else "0D"
    return f"CASE WHEN {inside} THEN ({now}) - {without} ELSE {add} END"


def _cost(criterion: str, t: int, j: int, s: Stats, placed: bool) -> str:
    p = f"p_{t}_{j}"
    if criterion == "SSE":
        return squared_distance(p, s)
    if criterion == "I2":
        return f"-({p} / {s.norm!r}D)" if s.norm > 0 else "0D"  # the document's own length changes no order
    inside = f"k_{t} <=> {j}" if placed else "false"
    return separation(p, "p_total", s, inside)


def assign(
    vectors: DataFrame, wide: DataFrame, stats: dict[tuple[int, int], Stats], criterion: str,
    previous: DataFrame | None = None,
) -> DataFrame:
    """``(id, k_t ...)``: the best cluster of every document, ties to the lowest.

    ``previous`` holds the assignment before this pass; E1 asks whether a document is a
    member, and trials without ``stats`` (converged ones) keep their column.
    """
    scored = dots(vectors, wide, list(stats))
    kept = []
    if previous is not None:
        scored = scored.join(previous, "id")
        kept = [c for c in previous.columns if c != "id" and c not in {f"k_{t}" for t, _ in stats}]
    best = []
    for t in sorted({t for t, _ in stats}):
        costs = ", ".join(
            f"struct(round({_cost(criterion, u, j, s, previous is not None)}, {SCORE_DIGITS}) AS cost, {j} AS k)"
            for (u, j), s in stats.items() if u == t
        )
        best.append(f"array_min(array({costs})).k AS k_{t}")
    return scored.selectExpr("id", *kept, *best)


def objective(criterion: str, stats: dict[int, Stats], own: float) -> float:
    """SSE: sum of squared distances; I2: sum of norms; E1: size-weighted cosine to the corpus.

    ``own`` is the sum of the documents' squared lengths, their number if all have length 1.
    """
    full = [s for s in stats.values() if s.n > 0 and s.norm2 > 0]
    if criterion == "SSE":
        return own - sum(s.norm2 / s.n for s in full)
    if criterion == "I2":
        return sum(s.norm for s in full)
    return sum(s.n * s.dot_total / s.norm for s in full)


def is_better(criterion: str, new: float, old: float) -> bool:
    return new > old if criterion == "I2" else new < old


@dataclass
class Trial:
    """State and outcome of one trial."""

    number: int
    objective: float = 0.0
    shift: float = float("inf")
    passes: int = 0
    converged: bool = False  # the shift fell below the limit before ``max_iter`` passes
    level: int = 0  # E1: the last pass admitted a share 2**-level of its moves
    sizes: dict[int, int] = field(default_factory=dict)
    assigned: DataFrame | None = None  # has columns id and k_<number>

    def assignment(self) -> DataFrame:
        return self.assigned.select("id", F.col(f"k_{self.number}").alias("k"))


@dataclass
class Batch:
    """A batch of trials that share every pass: the loop's state between passes."""

    criterion: str
    k: int
    vectors: DataFrame
    corpus: DataFrame | None
    wide: DataFrame
    stats: dict[tuple[int, int], Stats]
    trials: dict[int, Trial]
    own: float  # sum of the documents' squared lengths
    scratch: Scratch
    assigned: DataFrame | None = None
    improving: bool = True  # E1 passes admit only as many moves as lower the objective


def start(
    vectors: DataFrame, criterion: str, k: int, trials: range, seed: DataFrame, corpus: DataFrame | None
) -> Batch:
    scratch = Scratch(vectors.sparkSession, "kmeans")
    wide = scratch.table(with_corpus(seed_centroids(vectors, seed, k, trials), corpus), "centroids")
    sizes = {(t, j): 1 for t in trials for j in range(k)}
    own = vectors.agg(F.sum(F.col("w") * F.col("w"))).first()[0] or 0.0
    return Batch(criterion, k, vectors, corpus, wide, cluster_stats(wide, sizes), {t: Trial(t) for t in trials}, own, scratch)


@dataclass
class Rebuilt:
    """Centroids that follow from an assignment, with their scalars."""

    assigned: DataFrame
    sizes: dict[tuple[int, int], int]
    wide: DataFrame
    stats: dict[tuple[int, int], Stats]
    shift: dict[int, float]
    objectives: dict[int, float]


def _rebuild(state: Batch, assigned: DataFrame, active: list[int]) -> Rebuilt:
    """Centroids of the active trials from ``assigned``; an empty cluster keeps its previous centroid."""
    stats = {key: s for key, s in state.stats.items() if key[0] in active}
    sizes = cluster_sizes(assigned, state.k, active)
    wide = composites(state.vectors, assigned, state.k, active)
    empty = [key for key, n in sizes.items() if n == 0]
    if empty:
        kept = state.wide.select("dim", *[F.col(centroid(*key)).alias(f"old_{centroid(*key)}") for key in empty])
        wide = wide.join(kept, "dim", "full").na.fill(0.0)
        wide = wide.select(
            "dim",
            *[F.col(f"old_{centroid(*key)}" if key in empty else centroid(*key)).alias(centroid(*key)) for key in sizes],
        )
    wide = state.scratch.table(with_corpus(wide, state.corpus), "centroids")
    effective = {key: n or state.stats[key].n for key, n in sizes.items()}
    new_stats, shift = stats_and_shift(state.criterion, state.wide, wide, stats, effective)
    objectives = {
        t: objective(
            state.criterion,
            {j: Stats(sizes[t, j], new_stats[t, j].norm2, new_stats[t, j].dot_total) for j in range(state.k)}, state.own,
        ) for t in active
    }
    return Rebuilt(assigned, sizes, wide, new_stats, shift, objectives)


def _thinned(state: Batch, proposed: DataFrame, levels: dict[int, int | None], number: int) -> DataFrame:
    """The previous assignment with a share ``2**-level`` of the proposed moves of every trial.

    Which documents may move follows from a hash of the id and the pass. Level ``None`` admits the one
    document that comes first in hash order.
    """
    both = proposed.join(state.assigned.select("id", *[F.col(f"k_{t}").alias(f"old_{t}") for t in levels]), "id")
    order = digest(F.col("id"), F.lit(number))
    chosen = {}
    for t, level in levels.items():
        moves = ~F.col(f"k_{t}").eqNullSafe(F.col(f"old_{t}"))
        if level is None:
            first = both.filter(moves).agg(F.min(F.struct(order.alias("order"), F.col("id").alias("id")))["id"]).first()[0]
            chosen[t] = moves & (F.col("id") == F.lit(first)) if first is not None else F.lit(False)
        else:
            chosen[t] = moves & (F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint") % F.lit(1 << level) == 0)
    columns = [
        F.when(chosen[t], F.col(f"k_{t}")).otherwise(F.col(f"old_{t}")).alias(f"k_{t}") if t in chosen else F.col(f"k_{t}")
        for t in sorted(int(c[2:]) for c in proposed.columns if c != "id")
    ]
    return both.select("id", *columns)


def _improved(state: Batch, proposed: DataFrame, active: list[int]) -> tuple[Rebuilt, set[int]]:
    """E1: admit fewer and fewer of the proposed moves until no trial is worse than before the pass.

    Moves are proposed one by one with the exact change of the objective, but made together they may undo each other. A
    trial starts with eight times the share that its last pass admitted. If its objective did not fall, it tries again with an
    eighth of the moves, and at last with one document, whose change is exact. If even that does not lower it, the
    trial is settled: returns what was reached and the settled trials.
    """
    settled: set[int] = set()
    levels: dict[int, int | None] = {t: max(0, state.trials[t].level - 3) for t in active}
    while True:
        thinner = _thinned(state, proposed, {t: levels[t] for t in active if t not in settled}, state.trials[active[0]].passes)
        result = _rebuild(state, state.scratch.table(thinner, "assigned"), active)
        worse = [
            t for t in active
            if t not in settled and result.objectives[t] >= state.trials[t].objective - 1e-12 * abs(state.trials[t].objective)
        ]
        if not worse:
            for t in set(active) - settled:
                state.trials[t].level = THINNEST if levels[t] is None else levels[t]
            return result, settled
        state.scratch.drop(result.wide)
        last = {t for t in worse if levels[t] is None}
        settled |= last
        for t in worse:
            levels[t] = None if levels[t] is None or levels[t] >= THINNEST else levels[t] + 3
        if last:  # a settled trial stays as it was
            back = state.assigned.select("id", *[F.col(f"k_{t}").alias(f"old_{t}") for t in last])
            proposed = proposed.join(back, "id").select(
                "id", *[F.col(f"old_{c[2:]}").alias(c) if int(c[2:]) in last else F.col(c) for c in proposed.columns if c != "id"]
            )


def one_pass(state: Batch, active: list[int]) -> None:
    """Assign all documents, rebuild the centroids of the active trials, measure the shift.

    A pass of E1 never raises the objective; a trial that finds no improving move is settled (shift 0).
    """
    stats = {key: s for key, s in state.stats.items() if key[0] in active}
    needs_previous = state.assigned is not None and (
        state.criterion == "E1" or len(active) < len(state.trials)
    )
    assigned = state.scratch.table(
        assign(state.vectors, state.wide, stats, state.criterion, state.assigned if needs_previous else None),
        "assigned",
    )
    if state.criterion == "E1" and state.improving and state.assigned is not None:
        new, settled = _improved(state, assigned, active)
    else:
        new, settled = _rebuild(state, assigned, active), set()
    for t in active:
        trial = state.trials[t]
        trial.objective = new.objectives[t]
        trial.shift, trial.assigned = 0.0 if t in settled else new.shift[t], new.assigned
        trial.sizes = {j: new.sizes[t, j] for j in range(state.k)}
        trial.passes += 1
    state.scratch.drop(state.wide)
    state.wide, state.stats, state.assigned = new.wide, new.stats, new.assigned


def kmeans(
    vectors: DataFrame, k: int, criterion: str = "SSE", trials: int = 1, max_iter: int = 20,
    tol: float = SHIFT_LIMIT, keep: str | None = None, seed: DataFrame | None = None, improving: bool = True,
) -> list[Trial]:
    """Cluster vectors ``(id, dim, w)`` (I2 and E1 expect length 1); returns every trial, see :func:`best_trial`.

    ``keep='last'`` takes the state after the last pass, ``'best'`` the pass with the
    best objective. Passes of E1 admit only as many moves as improve it, so its last pass is its best;
    with ``improving=False`` all proposed moves are made at once, whatever they do to the objective.
    ``seed`` is an optional ``(trial, k, id)`` table in place of the hash-ordered seeds.
    """
    if criterion not in CRITERIA:
        raise ValueError(f"criterion must be one of {CRITERIA}")
    keep = keep or ("best" if criterion == "E1" else "last")
    # Partitioned by document once: every pass scores and joins without moving them.
    vectors = vectors.repartition("id").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seed = seeds(vectors, k, trials) if seed is None else seed
        corpus = materialize(V.unit(V.total(vectors)), "corpus") if criterion == "E1" else None
        done: list[Trial] = []
        step = max(1, MAX_SCORES // k)
        for first in range(0, trials, step):
            batch = range(first, min(first + step, trials))
            state = start(vectors, criterion, k, batch, seed, corpus)
            state.improving = improving
            best: dict[int, Trial] = {}
            active = list(batch)
            for _ in range(max_iter):
                one_pass(state, active)
                for t in active:
                    trial = state.trials[t]
                    trial.converged = trial.shift < tol
                    if t not in best or keep == "last" or is_better(criterion, trial.objective, best[t].objective):
                        best[t] = Trial(**trial.__dict__)
                active = [t for t in active if state.trials[t].shift >= tol]
                if not active:
                    break
            done += [best[t] for t in batch]
        return done
    finally:
        vectors.unpersist()


def best_trial(trials: list[Trial], criterion: str) -> Trial:
    """Largest objective for I2, smallest for SSE and E1; the earlier trial on a tie."""
    best = trials[0]
    for trial in trials[1:]:
        if is_better(criterion, trial.objective, best.objective):
            best = trial
    return best
