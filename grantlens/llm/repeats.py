"""Find which windows of a corpus occur more than once, without comparing pairs.

A window is named by its text and its first place. Rows stand for runs of neighbouring windows (places a to b
of text tid) that share a *core*, a part every one of them holds at the same distance, and have a
*full* hash of all that any of them holds. Equal windows lie in runs of equal cores. So

* a run whose core occurs once holds no repeated window and is dropped,
* a run whose full hash occurs again is settled: all of its windows are repeated,
* the other runs are open: looked at window by window, against one run of each full hash of the core.

Runs meet by their core. Before they are shuffled, equal runs of one batch are settled on the spot
and one of them goes on, so a passage that a third of all texts share is a few rows per batch; after
the shuffle, sorted runs are judged in a stream that remembers one row, whatever a core's number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: ``told`` rows carry settled runs through the shuffle; ``again`` marks runs that had equals in their batch.
RUNS = "core long, full long, tid long, a int, b int, told boolean, again boolean"
JUDGED = "core long, tid long, a int, b int, settled boolean"


def merged(tid: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one text that overlap or touch, joined."""
    if not len(tid):
        return tid, a, b
    order = np.lexsort((a, tid))
    tid, a, b = tid[order], a[order].astype(np.int64), b[order].astype(np.int64)
    shift = np.cumsum(np.concatenate([[0], tid[1:] != tid[:-1]])) * (int(b.max()) + 2)
    reach = np.maximum.accumulate(b + shift)
    opens = np.concatenate([[True], a[1:] + shift[1:] > reach[:-1] + 1])
    first = np.flatnonzero(opens)
    last = np.concatenate([first[1:] - 1, [len(a) - 1]])
    return tid[first], a[first], reach[last] - shift[last]


def collapsed(core: np.ndarray, full: np.ndarray, tid: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """The runs of a batch as RUNS: one of each kind, and the settled ones."""
    core, full = core.view(np.int64), full.view(np.int64)
    order = np.lexsort((full, core))
    core, full, tid, a, b = (x[order] for x in (core, full, tid, a, b))
    same = (core[1:] == core[:-1]) & (full[1:] == full[:-1])
    before, after = (x[:len(core)] for x in (np.concatenate([[False], same]), np.concatenate([same, [False]])))
    one = np.flatnonzero(~before)
    again = before | after
    t, x, y = merged(tid[again], a[again], b[again])
    return pd.DataFrame({
        "core": np.concatenate([core[one], t]), "full": np.concatenate([full[one], np.zeros(len(t), np.int64)]),
        "tid": np.concatenate([tid[one], t]), "a": np.concatenate([a[one], x]).astype(np.int32),
        "b": np.concatenate([b[one], y]).astype(np.int32),
        "told": np.arange(len(one) + len(t)) >= len(one),
        "again": np.concatenate([after[one], np.zeros(len(t), bool)]),
    })


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs sorted by told, core, full to JUDGED rows; a row is judged when the next one is known."""
    names = ["core", "full", "tid", "a", "b", "told", "again"]
    held: list[np.ndarray] | None = None  # the last row, not yet judged
    last = (None, None)  # core and full of the row before it
    first: tuple | None = None  # tid, a, b of the first run of the current core

    def judge(rows: list[np.ndarray], end: bool) -> Iterator[pd.DataFrame]:
        nonlocal held, last, first
        core, full, tid, a, b, told, again = rows
        n = len(core)
        if not end:
            held, n = [x[-1:] for x in rows], n - 1
        if not n:
            return
        new_core = np.concatenate([[core[0] != last[0] or first is None], core[1:] != core[:-1]]) | told
        new_full = new_core | np.concatenate([[full[0] != last[1]], full[1:] != full[:-1]])
        new_core, new_full = new_core[:n], new_full[:n]
        follows = np.zeros(n, bool)  # the next row is of the same kind
        size = min(n, len(core) - 1)
        follows[:size] = (core[:size] == core[1:size + 1]) & (full[:size] == full[1:size + 1]) & ~told[:size] & ~told[1:size + 1]
        settled = told[:n] | again[:n] | ~new_full | follows
        # a further kind of a core is open, and so is the first kind of that core
        further = new_full & ~new_core
        start = np.maximum.accumulate(np.where(new_core, np.arange(n), -1))[further]
        inside = np.unique(start[start >= 0])
        parts = [(core[:n][k], tid[:n][k], a[:n][k], b[:n][k], k_settled) for k, k_settled in (
            (np.flatnonzero(settled), True), (np.flatnonzero(further), False), (inside, False))]
        out = [pd.DataFrame({"core": c, "tid": t, "a": x, "b": y, "settled": s}) for c, t, x, y, s in parts]
        if (start < 0).any() and first is not None:
            out.append(pd.DataFrame({"core": core[:1], "tid": [first[0]], "a": [first[1]], "b": [first[2]], "settled": False}))
        opened = np.flatnonzero(new_core)
        if len(opened):
            k = opened[-1]
            first = (tid[k], a[k], b[k])
        last = (core[n - 1], full[n - 1])
        yield pd.concat(out, ignore_index=True)

    for batch in batches:
        rows = [batch[c].to_numpy() for c in names]
        if not len(rows[0]):
            continue
        if held is not None:
            rows = [np.concatenate([x, y]) for x, y in zip(held, rows, strict=True)]
        yield from judge(rows, end=False)
    if held is not None:
        yield from judge(held, end=True)


def judged(runs: DataFrame) -> DataFrame:
    """JUDGED rows of RUNS: settled runs, and the open runs of cores that have several kinds."""
    return runs.repartition("core").sortWithinPartitions("told", "core", "full").mapInPandas(_judge, JUDGED)


def by_text(judgements: DataFrame, settled: bool = True, name: str = "runs") -> DataFrame:
    """tid and its runs, as lists of their first and last places."""
    return judgements.where(F.col("settled") == settled).groupBy("tid").agg(
        F.collect_set(F.struct("a", "b")).alias(name)
    )


def unfolded(runs) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of a list of runs as Spark hands it over (rows or dicts; null: none)."""
    if runs is None or not len(runs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = [(r["a"], r["b"]) for r in runs]
    a, b = np.array(pairs, dtype=np.int64).T
    return a, b


def marked(n: int, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Which of ``n`` places a window of ``width`` covers that begins in one of the runs."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, a, 1)
    np.add.at(edge, np.minimum(b + width, n), -1)
    return np.cumsum(edge[:n]) > 0


def places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Every place in the runs, once each, ascending."""
    if not len(a):
        return np.zeros(0, np.int64)
    _, a, b = merged(np.zeros(len(a), np.int64), a, b)
    lengths = b - a + 1
    return np.repeat(a - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
