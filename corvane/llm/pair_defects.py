"""Prompt and response pairs of which the response does not serve the prompt."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.pair_features import LABELS, SPEECH, WIDTH, Features, looks_like
from corvane.llm.pair_spoiling import built_in, spoiled
from corvane.workspace import spread

DEFECTS = ["empty", "truncated", "refusal", "copied_prompt", "other_language"]
#: Most pairs the classifier is fitted on before they are spoiled, and most characters of one of them; all pairs are judged whole.
SAMPLE, FIT_CHARS = 4000, 1 << 17
#: Pairs spoiled in one task.
FIT_PART = 250
#: Part of the fitting pairs kept for the thresholds.
HELD_OUT = 0.25
#: Weight of a sound held-out row when the thresholds are set.
SOUND_WEIGHT = 8.0
#: Part of the best F1 that any threshold in the range reaches whose middle is taken.
NEAR_BEST = 0.998
#: Windows of a sound text that are fitted on, spread evenly; all are judged.
FIT_WINDOWS = 4
#: Sampled pairs below which built-in ones are fitted on too, and their number.
LEAST, BUILT_IN = 8, 240
#: Epochs of the first fits, which only find broken pairs of the sample, and of the last.
EPOCHS = (3, 7)
#: How often broken pairs are looked for; those found are left out of the next search.
CLEANED = 2


class Rows:
    """Sparse feature rows under construction."""

    def __init__(self):
        self.places: list[int] = []
        self.values: list[float] = []
        self.starts: list[int] = []

    def add(self, found: tuple[list[int], list[float]]) -> None:
        self.starts.append(len(self.places))
        self.places += found[0]
        self.values += found[1]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.places, np.int64), np.array(self.values, np.float32), np.array(self.starts, np.int64)


def featured(pairs: list[tuple[str, str]], held: bool, seed: int):
    """Rows of (label, first and second pair made of, whether it is an original, places, values) of spoiled pairs.

    A sound text is fitted on in some of its windows; what makes a defect stands in the
    comments, in the first window, or at the end of a long text.
    """
    features = Features()
    for x in spoiled(pairs, seed, late=held):
        found = features(x.prompt, x.target)
        if found is None:
            continue
        (places, values), windows = found
        last = len(windows) - 1
        some = {0 if "<!--" in x.target else last} if x.label >= 0 else {k * last // (FIT_WINDOWS - 1) for k in range(FIT_WINDOWS)}
        for nth in sorted(some):
            spoken = windows[max(0, nth)] if windows else ([], [])
            yield x.label, x.made_of[0], x.made_of[-1], x.original, places + spoken[0], values + spoken[1]
        if DEFECTS[x.label] == "refusal" and x.label >= 0 and not held:  # wordings are endless: what a refusal looks like must count without them
            yield x.label, x.made_of[0], x.made_of[-1], x.original, places, values


def scores(weights: np.ndarray, rows: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Weighted sums by row and defect."""
    places, values, starts = rows
    total = np.zeros((len(starts), weights.shape[1]), np.float32)
    step = 2048  # rows at a time: the gathered weights stay small
    for lo in range(0, len(starts), step):
        hi = min(len(starts), lo + step)
        end = starts[hi] if hi < len(starts) else len(places)
        part = weights[places[starts[lo] : end]] * values[starts[lo] : end, None]
        total[lo:hi] = np.add.reduceat(part, starts[lo:hi] - starts[lo], axis=0)
    return total


def judged(weights: np.ndarray, found: list) -> np.ndarray:
    """Scores of feature sets, each with the window of its text that scores highest for a defect."""
    rows, spoken, owner = Rows(), Rows(), []
    for k, (base, windows) in enumerate(found):
        rows.add(base)
        for window in windows:
            spoken.add(window)
            owner.append(k)
    total = scores(weights, rows.arrays())
    if owner:
        starts = np.nonzero(np.diff(owner, prepend=-1))[0]
        total[np.array(owner)[starts]] += np.maximum.reduceat(scores(weights, spoken.arrays()), starts, axis=0)
    return total


def _views() -> np.ndarray:
    """Which features each defect looks at: labels tell the language, speech all else."""
    seen = np.ones((WIDTH, len(DEFECTS)), np.float32)
    language = DEFECTS.index("other_language")
    seen[:LABELS] = 0
    seen[:LABELS, language] = 1
    seen[LABELS : LABELS + SPEECH, language] = 0
    return seen


def fit_linear(rows, labels, epochs: int, rate: float = 0.3, decay: float = 1e-5, seed: int = 3, batch_rows: int = 128) -> np.ndarray:
    """One-against-rest logistic regression by Adagrad over mini-batches."""
    rng = np.random.default_rng(seed)
    places, values, starts = rows
    n, k = len(starts), len(DEFECTS)
    ends = np.append(starts[1:], len(places))
    truth = (labels[:, None] == np.arange(k)[None, :]).astype(np.float32)
    weights, squares, seen = np.zeros((WIDTH, k), np.float32), np.full((WIDTH, k), 1e-4, np.float32), _views()
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, batch_rows):
            batch = order[lo : lo + batch_rows]
            size = ends[batch] - starts[batch]
            at = np.repeat(starts[batch] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            found, value, first = places[at], values[at][:, None], np.concatenate([[0], np.cumsum(size)[:-1]])
            z = np.add.reduceat(weights[found] * value, first, axis=0)
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth[batch]
            used, where = np.unique(found, return_inverse=True)
            spread = np.repeat(error, size, axis=0) * value
            gradient = np.stack([np.bincount(where, spread[:, c], len(used)) for c in range(k)], axis=1).astype(np.float32)
            gradient = (gradient + decay * weights[used]) * seen[used]
            squares[used] += gradient**2
            weights[used] -= rate * gradient / np.sqrt(squares[used])
    return weights


def thresholds(score: np.ndarray, labels: np.ndarray, sound_weight: float = SOUND_WEIGHT) -> np.ndarray:
    """For each defect the middle of the scores that give the best F1 on held-out rows, or nearly.

    The held-out rows say what the weights have not seen: other pairs in other wordings. A
    sound row weighs ``sound_weight``: they are that much rarer here than in a corpus.
    Nothing bounds the result; a defect without held-out rows keeps even odds.
    """
    out = np.zeros(len(DEFECTS), np.float32)
    for k in range(len(DEFECTS)):
        if not (labels == k).any():
            continue
        order = np.argsort(-score[:, k], kind="stable")
        right = labels[order] == k
        wrong = np.where(labels[order] < 0, sound_weight, 1.0) * ~right
        hits = np.cumsum(right)
        f1 = 2 * hits / (hits + np.cumsum(wrong) + right.sum())
        near = np.nonzero(f1 >= NEAR_BEST * f1.max())[0]  # the middle of where it hardly matters: new wordings score lower
        out[k] = (score[order[near[0]], k] + score[order[near[-1]], k]) / 2
    return out


class Fitting:
    """Featured rows of all parts, in arrays."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("part", "ascending"), ("nth", "ascending")]).combine_chunks()
        column = lambda name: table.column(name).to_numpy()
        part = column("part").astype(np.int64) << 32
        self.label, self.held, self.original = column("label").astype(np.int64), column("held"), column("original")
        self.first, self.second = part | column("first"), part | column("second")
        lists = table.column("places").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32()))
        self.places = lists.flatten().to_numpy().astype(np.int64)
        self.values = (table.column("values").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.float32()))).flatten().to_numpy()
        self.starts = lists.offsets.to_numpy()[:-1].astype(np.int64)
        self.sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)

    def pick(self, rows: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        """Places, values and starts of some rows, and their labels."""
        size = self.sizes[rows]
        first = np.cumsum(size) - size
        at = np.repeat(self.starts[rows] - first, size) + np.arange(size.sum())
        return (self.places[at], self.values[at], first), self.label[rows]


_FITTED = "part int, nth int, held boolean, label int, first int, second int, original boolean, places array<int>, values array<float>"


def _batch(part: int, held: bool, pairs: list[tuple[str, str]], seed: int) -> pa.Table:
    rows = list(featured(pairs, held, seed))
    n = len(rows)
    names = [f.split()[0] for f in _FITTED.split(", ")]
    return pa.Table.from_arrays([
        pa.array([part] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([held] * n, pa.bool_()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
        pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.bool_()), pa.array([r[4] for r in rows], pa.list_(pa.int32())), pa.array([r[5] for r in rows], pa.list_(pa.float32())),
    ], names=names)


def featured_pairs(pairs: list[tuple[str, str]], part: int, seed: int) -> pa.Table:
    """Featured rows of one part's pairs, the last of them held out."""
    cut = int(len(pairs) * (1 - HELD_OUT))
    return pa.concat_tables([_batch(2 * part, False, pairs[:cut], seed), _batch(2 * part + 1, True, pairs[cut:], seed)])


def _fitting_rows(records: DataFrame, size: int, seed: int = 5) -> pa.Table:
    """Featured rows of at most ``size`` sampled pairs, spoiled on the executors; their number does not depend on the data.

    Pairs are drawn by the hash of their id; with fewer than ``LEAST`` of them, built-in ones are added.
    """
    code = F.shiftrightunsigned(F.xxhash64("id", F.lit(29)), 2)  # 62 bits
    total = records.count()
    near = records.filter(code < int(min(1.0, 1.5 * size / max(1, total)) * (1 << 62)))
    usable = lambda c: (F.length(F.trim(c)) > 200) & (F.length(c) <= FIT_CHARS)
    fit = near.filter((F.coalesce("prompt", F.lit("")) != "") & (F.length("prompt") <= FIT_CHARS) & (usable("svg") | usable("diagram_ir")))
    last = fit.select(code.alias("c")).orderBy("c").limit(size).agg(F.max("c")).first()[0]
    tables = []
    if last is not None:
        parts = max(1, min(size, total) // FIT_PART)
        kept = F.array_compact(F.array(*[F.when(usable(c), F.col(c)) for c in ("svg", "diagram_ir")]))
        rows = fit.filter(code <= last).select(code.alias("code"), F.pmod(code, F.lit(parts)).cast("int").alias("part"), "prompt", F.element_at(kept, (F.pmod(F.xxhash64("id", F.lit(31)), F.size(kept)) + 1).cast("int")).alias("target"))

        def spoil(table: pa.Table) -> pa.Table:
            rows = sorted(zip(*(table.column(c).to_pylist() for c in ("code", "prompt", "target")), strict=True))
            part = table.column("part")[0].as_py()
            return featured_pairs([(p, t) for _, p, t in rows if looks_like(t) != "bare"], part, seed + part)

        tables.append(rows.groupBy("part").applyInArrow(lambda t: spoil(t), _FITTED).toArrow())
    if sum(t.filter(t.column("original")).num_rows for t in tables) < LEAST:
        tables.append(featured_pairs(built_in(BUILT_IN), -1, seed))
    return pa.concat_tables([t.cast(tables[0].schema) for t in tables])


def _broken(data: Fitting, use: np.ndarray) -> np.ndarray:
    """The sampled pairs that are broken themselves, each judged by weights fitted on the other half."""
    one, two = data.first & 1, data.second & 1
    found = []
    for half in (0, 1):
        weights = fit_linear(*data.pick(np.nonzero(use & ~data.held & (one == half) & (two == half))[0]), epochs=EPOCHS[0])
        held, labels = data.pick(np.nonzero(use & data.held)[0])
        limits = thresholds(scores(weights, held), labels, 1.0)  # broken pairs still count as sound here
        rows = np.nonzero(data.original & (data.held | (one != half)))[0]
        found.append(data.first[rows[(scores(weights, data.pick(rows)[0]) > limits).any(axis=1)]])
    return np.unique(np.concatenate(found))


def fit(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from featured rows of pairs that are mostly sound, without all rows made of broken pairs."""
    data = Fitting(table)
    use = np.ones(len(data.label), bool)
    for _ in range(CLEANED):
        broken = _broken(data, use)
        use = ~(np.isin(data.first, broken) | np.isin(data.second, broken))
    weights = fit_linear(*data.pick(np.nonzero(use & ~data.held)[0]), epochs=EPOCHS[1])
    held, labels = data.pick(np.nonzero(use & data.held)[0])
    return weights, thresholds(scores(weights, held), labels)


def defects(records: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``id, defect``: one row for each record whose response does not serve its prompt.

    Each target is judged by the classifier, whole, in windows of its running text; ``empty`` needs both to show nothing, any
    other defect of one target is enough, the surest is given. Null prompts count as
    empty texts; an empty table gives no rows. A table with fewer than ``LEAST`` pairs to fit
    on is judged by built-in pairs besides; blank targets need no fit.
    """
    spark = records.sparkSession
    schema = "id string, defect string"
    if records.isEmpty():
        return spark.createDataFrame([], schema)
    weights, limits = fit(_fitting_rows(records, sample))
    shared = spark.sparkContext.broadcast((weights.astype(np.float32), limits))  # WIDTH rows, whatever the data

    def judge(batches):
        features = Features()
        weights, limits = shared.value
        for batch in batches:
            ids, prompts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            held, owner, blank = [], [], np.zeros((len(ids), 2), bool)
            for side in range(2):
                for k, (prompt, target) in enumerate(zip(prompts, batch.column(2 + side).to_pylist(), strict=True)):
                    found = features(prompt or "", target or "")
                    if found is None:
                        blank[k, side] = True
                        continue
                    held.append(found)
                    owner.append((k, side))
            over = judged(weights, held) - limits
            best: dict[int, tuple[float, int]] = {}
            for (k, side), row in zip(owner, over, strict=True):
                worst = int(np.argmax(row))
                if row[worst] <= 0:
                    continue
                if worst == 0:
                    blank[k, side] = True
                elif row[worst] > best.get(k, (0.0, 0))[0]:
                    best[k] = (float(row[worst]), worst)
            out = [(ids[k], DEFECTS[best[k][1]] if k in best else "empty") for k in range(len(ids)) if k in best or blank[k].all()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in out], pa.string()), pa.array([f[1] for f in out], pa.string())], names=["id", "defect"])

    return spread(records.select("id", "prompt", "svg", "diagram_ir")).mapInArrow(judge, schema)
