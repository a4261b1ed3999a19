"""Tree ensembles over many training samples and settings at once.

A sample is a set of training rows with the rows held out for it (a fold). Cut points of
all samples come from one aggregate. From there two ways lead to the same trees:

* by level: rows become binned blocks that carry the predictions of every setting. Per
  depth, each block counts its histograms, they are summed by (sample, setting, node), and
  only the best split of each node reaches the driver. Nothing grows with the data but
  the blocks. Predictions are kept in memory and written every ``WRITTEN`` rounds, so a lost
  executor repeats few of them.
* by group: if a sample was counted and has at most ``spark.panelkit.maxGroupRows`` rows
  (default ``GROUP_ROWS``), each (sample, setting) is fitted in one task from its binned blocks,
  which take a byte a feature. A round then costs no job, so the limit is what a task can hold. The trees of a forest do not see each
  other: ``TREES`` of them are a task.

Sums are sums of integers and percentiles are exact, so both ways agree to the bit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.errors import ContractError
from panelkit.operators import trees as T
from panelkit.operators.ordering import group_limit
from panelkit.operators.quantiles import grouped_percentiles
from panelkit.staging import stage

KEPT = ("zip", "month", "target")
PROBABILITIES = [(i + 1) / (T.BINS - 1) for i in range(T.BINS - 2)] + [0.5]
GROUP_ROWS = 16_000_000  # binned rows of a sample in one task: at 25 features 120 bytes a row, a forest 165
WRITTEN = 10  # rounds between writes of the predictions
TREES = 30  # of a forest in one task
PARTIAL = 64  # sums of histograms per node in the first step

PREDICTIONS = "setting int, sample int, rounds int, zip string, month date, target double, prediction double"
NODES = (
    "setting int, sample int, tree int, node int, feature int, cut double, missing_left boolean, "
    "left int, right int, value double, cover double"
)
BLOCKS = "sample int, zip array<string>, month array<date>, y binary, train binary, hash binary, bins binary"
STATE = f"{BLOCKS}, prediction binary"


# --- samples, cut points --------------------------------------------------------


def whole_sample(rows: DataFrame) -> DataFrame:
    """All rows as the training rows of sample 0."""
    return rows.withColumns({"sample": F.lit(0), "train": F.lit(True)})


def cut_points(samples: DataFrame, columns: Sequence[str]) -> dict[int, tuple[list[np.ndarray], list[float]]]:
    """Cut points and medians of every feature per sample, from its training rows."""
    wanted = F.array(*[F.lit(p) for p in PROBABILITIES])
    made = samples.where("train").groupBy("sample").agg(
        *[F.percentile_approx(F.col(c).cast("double"), wanted, 10_000).alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    out = {}
    for row in made.collect():  # one row a sample
        found = [row[f"_c{i}"] for i in range(len(columns))]
        cuts = [np.unique(np.array(f[:-1])) if f else np.zeros(0) for f in found]
        out[row["sample"]] = cuts, [f[-1] if f else float("nan") for f in found]
    return out


def scale_of(samples: DataFrame) -> float:
    """Power of two not below any training target."""
    most = samples.where("train").agg(F.max(F.abs("target"))).first()[0]
    if most is None:
        raise ContractError("no training row has a target")
    return float(2.0 ** np.ceil(np.log2(most))) if most > 0 else 1.0


def _matrix(pdf: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    return pdf[list(columns)].to_numpy(dtype=float, na_value=np.nan)


def _typed(samples: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only what the fits read; training rows need a target."""
    features = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]
    kept = samples.where("NOT train OR target IS NOT NULL")
    return kept.select("sample", "train", "zip", "month", F.col("target").cast("double").alias("target"), *features)


@dataclass(frozen=True)
class Job:
    """What every task of a fit knows."""

    columns: tuple[str, ...]
    settings: tuple[T.TreeSettings, ...]
    marks: tuple[tuple[int, ...], ...]
    cuts: dict
    scale: float
    seed: int

    def bins(self, sample: int, values: np.ndarray, impute: bool) -> np.ndarray:
        cuts, medians = self.cuts[sample]
        return T.bin_values(values, cuts, medians if impute else None)


def node_rows(job: Job, sample: int, setting: int, number: int, tree: T.Tree) -> pd.DataFrame:
    """Rows of NODES; values are what a leaf adds to the prediction."""
    cuts, medians = job.cuts[sample]
    s = job.settings[setting]
    feature = np.array(tree.feature)
    # a bin above the last cut point parts all values from the missing ones
    edges = [np.append(c, np.inf) for c in cuts]
    cut = np.array([edges[f][min(b, len(edges[f])) - 1] if f >= 0 else np.nan for f, b in zip(tree.feature, tree.bin)])
    missing = np.array(tree.missing_left)
    if s.impute:
        missing = np.array([f < 0 or not medians[f] > c for f, c in zip(tree.feature, cut)])
    return pd.DataFrame(
        {
            "setting": setting, "sample": sample, "tree": number, "node": np.arange(len(feature)), "feature": feature,
            "cut": cut, "missing_left": missing, "left": tree.left, "right": tree.right,
            "value": tree.added(s, job.scale), "cover": tree.cover,
        }
    )


def base_row(sample: int, setting: int, base: float) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "setting": [setting], "sample": [sample], "tree": [-1], "node": [0], "feature": [-1], "cut": [np.nan],
            "missing_left": [True], "left": [-1], "right": [-1], "value": [base], "cover": [0.0],
        }
    )


# --- blocks ---------------------------------------------------------------------


def _blocks(samples: DataFrame, job: Job) -> DataFrame:
    """Binned rows, some thousand to a block; only the held-out ones keep their zip and month."""
    impute = job.settings[0].impute
    if any(s.impute != impute for s in job.settings):
        raise ContractError("settings of one fit must treat missing values alike")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for sample, pdf in batch.groupby("sample"):
                train = pdf["train"].to_numpy(dtype=bool)
                values = _matrix(pdf, [f"_x{i}" for i in range(len(job.columns))])
                yield pd.DataFrame(
                    {
                        "sample": [int(sample)],
                        "zip": [pdf.loc[~train, "zip"].tolist()],
                        "month": [pdf.loc[~train, "month"].tolist()],
                        "y": [pdf["target"].to_numpy(dtype=float, na_value=np.nan).tobytes()],
                        "train": [train.tobytes()],
                        "hash": [pdf["hash"].to_numpy(dtype=np.int64).tobytes()],
                        "bins": [job.bins(int(sample), values, impute).tobytes()],
                    }
                )

    return samples.withColumn("hash", F.xxhash64("zip", "month")).mapInPandas(run, BLOCKS)


# --- by group -------------------------------------------------------------------


def _group_tasks(job: Job) -> list[tuple[int, int, range]]:
    """(sample, setting, numbers of trees) of every task, the longest first."""
    made = []
    for setting, s in enumerate(job.settings):
        step = TREES if s.averaged else max(s.rounds, 1)
        for sample in sorted(job.cuts):
            made += [(sample, setting, range(at, min(at + step, s.rounds))) for at in range(0, max(s.rounds, 1), step)]
    return sorted(made, key=lambda t: -len(t[2]) * (1 + job.settings[t[1]].depth))


def _whole(held: Sequence[pd.DataFrame], features: int) -> tuple[np.ndarray, ...]:
    """Arrays of all rows of a task: targets, train, hashes, bins by column."""
    plain = [
        np.frombuffer(b"".join(v for part in held for v in part.pop(name)), dtype=kind)
        for name, kind in (("y", float), ("train", bool), ("hash", np.int64))
    ]
    bins, at = np.empty((features, len(plain[0])), dtype=np.uint8), 0
    for part in held:
        for packed in part.pop("bins"):
            own = np.frombuffer(packed, dtype=np.uint8).reshape(-1, features)
            bins[:, at : at + len(own)] = own.T
            at += len(own)
    return *plain, bins.T


def _by_group(samples: DataFrame, job: Job, nodes: bool) -> DataFrame:
    """Each (sample, setting) in one task, as binned blocks; predictions at the marks, or the trees."""
    tasks = _group_tasks(job)

    def fit(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample, setting, numbers = tasks[int(held[0]["_group"].iloc[0])]
        s, marks = job.settings[setting], job.marks[setting]
        if not nodes:
            # rows of a block are told apart by their place: keys may repeat
            sizes = [len(v) for part in held for v in part["zip"]]
            kept = pd.DataFrame({name: [v for part in held for own in part.pop(name) for v in own] for name in ("zip", "month")})
            kept["block"] = np.repeat(np.concatenate([part["block"].to_numpy(dtype=np.int64) for part in held]), sizes)
            kept["place"] = np.concatenate([np.arange(n, dtype=np.int64) for n in sizes])
        y, train, hashes, bins = _whole(held, len(job.columns))
        held.clear()
        if not nodes:
            kept = kept.assign(target=y[~train], setting=setting, sample=sample)
        steps = T.boost(bins, y, train, hashes, s, job.seed, job.scale, numbers, whole=False)
        base, _ = next(steps)
        if nodes and numbers.start == 0:
            yield base_row(sample, setting, base)
        for number, (tree, prediction) in zip(numbers, steps):
            if nodes:
                yield node_rows(job, sample, setting, number, tree)
                continue
            for mark in marks:
                if mark == number + 1 or (number + 1 == numbers.stop and mark > numbers.stop):
                    made = kept.assign(rounds=mark, prediction=prediction[~train])
                    yield made[["setting", "sample", "rounds", "zip", "month", "target", "prediction", "block", "place"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []
        for batch in batches:
            for own, part in batch.groupby("_group", sort=True):
                if own != key and held:
                    yield from fit(held)
                    held = []
                key = own
                held.append(part.copy())
        if held:
            yield from fit(held)

    blocks = stage(_blocks(samples, job).withColumn("block", F.monotonically_increasing_id()), "blocks")
    of_sample = F.create_map(*[
        F.lit(x) for a in job.cuts for x in (a, F.array(*[F.lit(i) for i, t in enumerate(tasks) if t[0] == a]))
    ])
    names = [n for n in blocks.columns if not nodes or n not in KEPT]
    spread = blocks.select(*names, F.explode(F.element_at(of_sample, F.col("sample"))).alias("_group"))
    placed = spread.repartitionById(len(tasks), F.col("_group")).sortWithinPartitions("_group")
    if nodes:
        return placed.mapInPandas(run, NODES)
    made = placed.mapInPandas(run, f"{PREDICTIONS}, block long, place long")
    if any(len(t[2]) < job.settings[t[1]].rounds for t in tasks):
        names = ["setting", "sample", "rounds"]
        row = [F.first(n).alias(n) for n in KEPT]
        made = made.groupBy(*names, "block", "place").agg(*row, F.sum("prediction").alias("prediction"))
        made = made.select(*names, *KEPT, "prediction", "block", "place")
    return made.drop("block", "place")


# --- by level -------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """Arrays of one row of STATE."""

    sample: int
    y: np.ndarray
    train: np.ndarray
    hashes: np.ndarray
    bins: np.ndarray
    prediction: np.ndarray  # (settings, rows)


def _opened(batch: pa.RecordBatch, features: int) -> Iterator[tuple[int, Block]]:
    get = {name: batch.column(name) for name in batch.schema.names}
    for i in range(batch.num_rows):
        y = np.frombuffer(get["y"][i].as_py(), dtype=float)
        block = Block(
            get["sample"][i].as_py(),
            y,
            np.frombuffer(get["train"][i].as_py(), dtype=bool),
            np.frombuffer(get["hash"][i].as_py(), dtype=np.int64),
            np.frombuffer(get["bins"][i].as_py(), dtype=np.uint8).reshape(len(y), features),
            np.frombuffer(get["prediction"][i].as_py(), dtype=float).reshape(-1, len(y)),
        )
        yield i, block


HISTOGRAMS = "sample int, setting int, node int, part int, hist binary"
SPLITS = (
    "sample int, setting int, node int, gain double, feature int, bin int, missing_left boolean, "
    "left_g double, left_n double, total_g double, total_n double"
)


def _summed(hists: DataFrame, keys: Sequence[str], finish, schema: str) -> DataFrame:
    """Sum histograms of equal keys, sorted, holding one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, done = None, None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in keys]
            for *own, packed in zip(*columns, batch.column("hist")):
                part = np.frombuffer(packed.as_py(), dtype=float)
                if own == key:
                    total = total + part
                    continue
                if key is not None:
                    done.append(finish(key, total))
                key, total = own, part
            if len(done) >= 64:
                yield pa.RecordBatch.from_pylist(done)
                done = []
        if key is not None:
            done.append(finish(key, total))
        if done:
            yield pa.RecordBatch.from_pylist(done)

    return hists.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


class _Levels:
    """The rounds of a fit by level."""

    def __init__(self, samples: DataFrame, job: Job):
        self.job, self.spark = job, samples.sparkSession
        self.features = len(job.columns)
        blocks = stage(_blocks(samples, job), "blocks")
        self.keys = [(a, b) for a in sorted(job.cuts) for b in range(len(job.settings))]
        self.bases = self.base_values(samples)
        bases = self.bases
        settings = len(job.settings)

        def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                packed = []
                for i in range(batch.num_rows):
                    n = len(batch.column("y")[i].as_py()) // 8
                    sample = batch.column("sample")[i].as_py()
                    first = np.array([bases[sample, k] for k in range(settings)])
                    packed.append(np.repeat(first, n).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(packed, type=pa.binary())], names=[*batch.schema.names, "prediction"]
                )

        self.parts = 1 + blocks.rdd.getNumPartitions() // PARTIAL
        self.state, self.held = blocks.mapInArrow(start, STATE), []

    def base_values(self, samples: DataFrame) -> dict[tuple[int, int], float]:
        job = self.job
        rows = samples.where("train")
        unit = F.rint(F.col("target") * F.lit(T.UNIT / job.scale))
        plain = {r["sample"]: r["s"] / r["n"] * (job.scale / T.UNIT) for r in rows.groupBy("sample").agg(F.sum(unit).alias("s"), F.count(F.lit(1)).alias("n")).collect()}
        levels = sorted({s.quantile for s in job.settings if s.quantile is not None})
        wanted = {f"q{i}": ("target", q) for i, q in enumerate(levels)}
        picked = {r["sample"]: r for r in grouped_percentiles(rows, ["sample"], wanted).collect()} if levels else {}
        out = {}
        for sample, setting in self.keys:
            s = job.settings[setting]
            if s.averaged:
                out[sample, setting] = 0.0
            elif s.quantile is not None:
                out[sample, setting] = round(picked[sample][f"q{levels.index(s.quantile)}"], T.PLACES)
            else:
                out[sample, setting] = plain[sample]
        return out

    def splits(self, number: int, trees: dict, nodes: dict, depth: int) -> dict:
        """The best split of every open node."""
        job, features, parts = self.job, self.features, self.parts

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            sums = {}
            for batch in batches:
                for _, b in _opened(batch, features):
                    rows = np.flatnonzero(b.train)
                    for setting, s in enumerate(job.settings):
                        own = nodes.get((b.sample, setting))
                        if not own:
                            continue
                        tree, w, inside = trees[b.sample, setting], T.drawn(b.hashes, number, s, job.seed), rows
                        g = T.gradients(b.y, b.prediction[setting], s, job.scale)
                        if w is not None:
                            g, inside = g * w, rows[w[rows] > 0]
                        slot = np.full(len(tree.feature), -1)
                        slot[own] = np.arange(len(own))
                        at = slot[T.leaves_of(b.bins[inside], tree, depth)]
                        hist = T.histograms(b.bins, at, len(own), g, w, inside)
                        for k, node in enumerate(own):
                            key = (b.sample, setting, node)
                            sums[key] = sums[key] + hist[:, k] if key in sums else hist[:, k]
            part = TaskContext.get().partitionId() % parts
            for at in range(0, len(sums), 64):
                some = list(sums.items())[at : at + 64]
                rows = [dict(zip(("sample", "setting", "node"), k)) | {"part": part, "hist": h.tobytes()} for k, h in some]
                yield pa.RecordBatch.from_pylist(rows, schema=hist_schema)

        hist_schema = pa.schema([("sample", pa.int32()), ("setting", pa.int32()), ("node", pa.int32()), ("part", pa.int32()), ("hist", pa.binary())])

        def partial(key, total):
            return dict(zip(("sample", "setting", "node", "part"), map(np.int32, key))) | {"hist": total.tobytes()}

        def best(key, total):
            s = job.settings[key[1]]
            hist = total.reshape(2, 1, features, T.BINS)
            found = T.best_splits(hist, s.l2, s.least)
            sums = {"total_g": hist[0, 0, 0].sum(), "total_n": hist[1, 0, 0].sum()}
            out = dict(zip(("sample", "setting", "node"), map(np.int32, key)))
            out |= {k: np.int32(v[0]) if k in ("feature", "bin") else v[0] for k, v in found.items()}
            names = [n.split()[0] for n in SPLITS.split(", ")]
            return {n: (out | sums)[n] for n in names}

        hists = self.state.mapInArrow(count, HISTOGRAMS)
        if parts > 1:
            hists = _summed(hists, ["sample", "setting", "node", "part"], partial, HISTOGRAMS)
        found = _summed(hists, ["sample", "setting", "node"], best, SPLITS)
        # as many rows as there are open nodes, which the settings bound
        return {(r["sample"], r["setting"], r["node"]): r.asDict() for r in found.collect()}

    def grown(self, number: int) -> dict:
        """The trees of one round."""
        job = self.job
        trees = {k: T.Tree() for k in self.keys if number < job.settings[k[1]].rounds}
        nodes = {k: [0] for k in trees}
        for depth in range(max(job.settings[k[1]].depth for k in trees)):
            nodes = {k: own for k, own in nodes.items() if own and depth < job.settings[k[1]].depth}
            if not nodes:
                break
            found = self.splits(number, trees, nodes, depth)
            for key, own in nodes.items():
                tree, rows = trees[key], [found[*key, node] for node in own if (*key, node) in found]
                if depth == 0 and rows:
                    tree.total, tree.cover = [rows[0]["total_g"]], [rows[0]["total_n"]]
                splits = {name: np.array([r[name] for r in rows]) for name in (rows[0] if rows else ("gain",))}
                nodes[key] = tree.grow(own, splits, job.settings[key[1]].leaves) if rows else []
        self.set_values(number, trees)
        return trees

    def set_values(self, number: int, trees: dict) -> None:
        job, features = self.job, self.features
        picked = {k for k in trees if job.settings[k[1]].quantile is not None}
        for key in trees.keys() - picked:
            trees[key].value = trees[key].means(job.settings[key[1]].l2, job.scale)
        if not picked:
            return

        def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for _, b in _opened(batch, features):
                    for setting, s in enumerate(job.settings):
                        if s.quantile is None or (b.sample, setting) not in trees:
                            continue
                        leaf = T.leaves_of(b.bins[b.train], trees[b.sample, setting], s.depth)
                        rest = (b.y - b.prediction[setting])[b.train]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "sample": pa.array(np.full(len(leaf), b.sample, dtype=np.int32)),
                                "setting": pa.array(np.full(len(leaf), setting, dtype=np.int32)),
                                "leaf": pa.array(leaf.astype(np.int32)),
                                "rest": pa.array(rest),
                            }
                        )

        rows = self.state.mapInArrow(residuals, "sample int, setting int, leaf int, rest double")
        for level in sorted({job.settings[k[1]].quantile for k in picked}):
            own = [i for i, s in enumerate(job.settings) if s.quantile == level]
            found = grouped_percentiles(rows.where(F.col("setting").isin(own)), ["sample", "setting", "leaf"], {"v": ("rest", level)})
            for key in picked:
                if key[1] in own:
                    trees[key].value = np.zeros(len(trees[key].feature))
            for r in found.collect():  # one row a leaf
                trees[r["sample"], r["setting"]].value[r["leaf"]] = round(r["v"], T.PLACES)

    def add(self, trees: dict, number: int) -> None:
        """Predictions after this round."""
        job, features = self.job, self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                packed = []
                for _, b in _opened(batch, features):
                    made = b.prediction.copy()
                    for setting, s in enumerate(job.settings):
                        tree = trees.get((b.sample, setting))
                        if tree is not None:
                            made[setting] = made[setting] + tree.added(s, job.scale)[T.leaves_of(b.bins, tree, s.depth)]
                    packed.append(made.tobytes())
                columns = [batch.column(n) for n in batch.schema.names if n != "prediction"]
                names = [n for n in batch.schema.names if n != "prediction"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, type=pa.binary())], names=[*names, "prediction"])

        after = self.state.mapInArrow(run, STATE)
        if (number + 1) % WRITTEN == 0:
            after = stage(after, "predictions")
            while self.held:
                self.held.pop().unpersist()
        else:
            after = after.persist()
            self.held.append(after)
        self.state = after

    def held_out(self, setting: int, rounds: int) -> DataFrame:
        """Predictions of the rows that no tree of their sample was fitted on."""
        features = self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, b in _opened(batch, features):
                    own = np.flatnonzero(~b.train)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "setting": pa.array(np.full(len(own), setting, dtype=np.int32)),
                            "sample": pa.array(np.full(len(own), b.sample, dtype=np.int32)),
                            "rounds": pa.array(np.full(len(own), rounds, dtype=np.int32)),
                            "zip": batch.column("zip")[i].values,
                            "month": batch.column("month")[i].values,
                            "target": pa.array(b.y[own], mask=np.isnan(b.y[own])),
                            "prediction": pa.array(b.prediction[setting][own]),
                        }
                    )

        return stage(self.state.mapInArrow(run, PREDICTIONS), "held_out")

    def run(self, nodes: bool) -> DataFrame:
        job, out = self.job, []
        if nodes:
            out = [base_row(a, b, self.bases[a, b]) for a, b in self.keys]
        for number in range(max(s.rounds for s in job.settings)):
            trees = self.grown(number)
            self.add(trees, number)
            for setting, marks in enumerate(job.marks):
                if not nodes and number + 1 in marks:
                    out.append(self.held_out(setting, number + 1))
            if nodes:
                out += [node_rows(job, *key, number, tree) for key, tree in trees.items()]
        while self.held:
            self.held.pop().unpersist()
        if nodes:
            return self.spark.createDataFrame(pd.concat(out), NODES)
        whole = out[0]
        for part in out[1:]:
            whole = whole.unionByName(part)
        return whole


# --- fits -----------------------------------------------------------------------


def _fit(
    samples: DataFrame,
    columns: Sequence[str],
    settings: Sequence[T.TreeSettings],
    marks: Sequence[Sequence[int]],
    seed: int,
    nodes: bool,
    max_group: int | None,
) -> DataFrame:
    rows = _typed(samples, columns)
    names = [f"_x{i}" for i in range(len(columns))]
    job = Job(tuple(columns), tuple(settings), tuple(map(tuple, marks)), cut_points(rows, names), scale_of(rows), seed)
    largest = rows.groupBy("sample").count().agg(F.max("count")).first()[0]
    if largest <= group_limit(samples.sparkSession, max_group, GROUP_ROWS):
        return _by_group(rows, job, nodes)
    return _Levels(rows, job).run(nodes)


def held_out_predictions(
    samples: DataFrame,
    columns: Sequence[str],
    settings: Sequence[T.TreeSettings],
    marks: Sequence[Sequence[int]] | None = None,
    seed: int = 0,
    max_group: int | None = None,
) -> DataFrame:
    """Predictions of the held-out rows of every sample by every setting.

    ``marks`` lists the numbers of rounds to report for each setting (default: the last), so
    that settings which differ only in their number of rounds are one fit. ``samples`` has
    ``sample``, ``train``, zip, month, target and the features.
    """
    chosen = marks or [(s.rounds,) for s in settings]
    return stage(_fit(samples, columns, settings, chosen, seed, False, max_group), "held_out")


def fit_trees(
    rows: DataFrame, columns: Sequence[str], settings: Sequence[T.TreeSettings], seed: int = 0, max_group: int | None = None
) -> list["TreeModel"]:
    """One fitted ensemble per setting, on all rows that have a target."""
    return TreeModel.read(fit_nodes(whole_sample(rows), columns, settings, seed, max_group), columns, len(settings))


def fit_nodes(
    samples: DataFrame, columns: Sequence[str], settings: Sequence[T.TreeSettings], seed: int = 0, max_group: int | None = None
) -> DataFrame:
    """The trees of every sample and setting as rows (NODES), written."""
    return stage(_fit(samples, columns, settings, [()] * len(settings), seed, True, max_group), "trees")


# --- models ---------------------------------------------------------------------


@dataclass(frozen=True)
class TreeModel:
    """Base and node arrays of an ensemble. Their size follows the settings, not the data."""

    columns: tuple[str, ...]
    base: float
    trees: tuple[dict[str, np.ndarray], ...]

    @staticmethod
    def read(nodes: DataFrame, columns: Sequence[str], settings: int) -> list["TreeModel"]:
        pdf = nodes.toPandas().sort_values(["setting", "tree", "node"], kind="stable")
        out = []
        for setting in range(settings):
            own = pdf[pdf["setting"] == setting]
            arrays = [
                {
                    "feature": t["feature"].to_numpy(dtype=np.int64), "cut": t["cut"].to_numpy(dtype=float),
                    "missing_left": t["missing_left"].to_numpy(dtype=bool), "left": t["left"].to_numpy(dtype=np.int64),
                    "right": t["right"].to_numpy(dtype=np.int64), "value": t["value"].to_numpy(dtype=float),
                    "cover": t["cover"].to_numpy(dtype=float),
                }
                for number, t in own.groupby("tree", sort=True)
                if number >= 0
            ]
            base = float(own.loc[own["tree"] == -1, "value"].iloc[0])
            out.append(TreeModel(tuple(columns), base, tuple(arrays)))
        return out

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, ensemble_values([self])[0])

    def nodes(self, spark: SparkSession, setting: int = 0) -> DataFrame:
        parts = [base_row(0, setting, self.base)]
        for number, t in enumerate(self.trees):
            part = pd.DataFrame({"setting": setting, "sample": 0, "tree": number, "node": np.arange(len(t["feature"])), **t})
            parts.append(part[list(parts[0].columns)])
        return spark.createDataFrame(pd.concat(parts), NODES)

    def save(self, path: str) -> None:
        save_models([self], path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeModel":
        return load_models(spark, path)[0]


def save_models(models: Sequence[TreeModel], path: str) -> None:
    """Nodes and feature names of models over the same features."""
    spark = SparkSession.active()
    whole = models[0].nodes(spark)
    for i, model in enumerate(models[1:], 1):
        whole = whole.unionByName(model.nodes(spark, i))
    whole.write.mode("overwrite").parquet(f"{path}/nodes")
    names = [(i, c, len(models)) for i, c in enumerate(models[0].columns)]
    spark.createDataFrame(names, "slot int, feature string, models int").write.mode("overwrite").parquet(f"{path}/features")


def load_models(spark: SparkSession, path: str) -> list[TreeModel]:
    names = spark.read.parquet(f"{path}/features").orderBy("slot").collect()  # one row a feature
    return TreeModel.read(spark.read.parquet(f"{path}/nodes"), [r["feature"] for r in names], names[0]["models"])


def goes_left(tree: dict[str, np.ndarray], matrix: np.ndarray, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    value = matrix[rows, tree["feature"][node]]
    return np.where(np.isnan(value), tree["missing_left"][node], value <= tree["cut"][node])


def predicted(model: TreeModel, matrix: np.ndarray) -> np.ndarray:
    """Predictions of a (rows, features) matrix; NaN is missing."""
    out = np.full(len(matrix), model.base)
    for tree in model.trees:
        node = np.zeros(len(matrix), dtype=np.int64)
        rows = np.flatnonzero(tree["feature"][node] >= 0)
        while len(rows):
            own = node[rows]
            node[rows] = np.where(goes_left(tree, matrix, rows, own), tree["left"][own], tree["right"][own])
            rows = rows[tree["feature"][node[rows]] >= 0]
        out = out + tree["value"][node]
    return out


def ensemble_values(models: Sequence[TreeModel]) -> Column:
    """Array with the prediction of each model, from the feature columns of the row."""
    columns = models[0].columns

    @F.pandas_udf("array<double>")
    def values(rows: pd.DataFrame) -> pd.Series:
        matrix = rows.to_numpy(dtype=float, na_value=np.nan)
        return pd.Series(list(np.stack([predicted(m, matrix) for m in models], axis=1)))

    return values(F.struct(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]))
