import hashlib

import numpy as np
import pyarrow as pa
import pytest

from regflow.llm import exact_dedup
from regflow.llm.exact_dedup import Blocks, Run, exact_duplicates, joined, merge_blocks


def brute(rows, largest=True):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(low(t), []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[low(t)]
        known = [x for x in ids if x is not None]
        keep = (max if largest else min)(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


ROWS = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (6, ""), (None, "abc"), (None, "z"), (9, "x" * 200_000)]


def test_matches_brute_force(docs_of):
    rows = ROWS + [(100 + i, "hot") for i in range(500)] + [(1000 + i, f"t{i % 90}") for i in range(300)]
    frame = docs_of(rows).repartition(13)
    assert got(exact_duplicates(frame)) == brute(rows)
    assert got(exact_duplicates(frame, keep="smallest")) == brute(rows, largest=False)


def test_empty_table(docs_of):
    assert got(exact_duplicates(docs_of([]))) == []


def a_run(rng, n, kinds):
    keys = rng.integers(0, 256, (kinds, 48)).astype(np.uint8)
    keys[:, 40:] *= rng.integers(0, 2, (kinds, 1)).astype(np.uint8)  # keys that end in zeros
    chosen = np.ascontiguousarray(keys[rng.integers(0, kinds, n)]).view("S48").ravel()
    order = np.argsort(chosen)
    known = rng.random(n) < 0.7
    ids = np.where(known, rng.integers(0, 1000, n), np.iinfo(np.int64).min)
    return Run(chosen[order], ids[order], known[order], np.ones(n, np.int64)).folded(True)


@pytest.mark.parametrize("block", [1, 3, 50, 4096])
def test_many_runs_are_merged_block_by_block(monkeypatch, block):
    monkeypatch.setattr(exact_dedup, "BLOCK", block)
    rng = np.random.default_rng(block)
    shared = np.random.default_rng(77)
    runs = [a_run(np.random.default_rng(8), 60, 40), a_run(np.random.default_rng(8), 90, 40)]
    runs += [a_run(rng, int(shared.integers(1, 200)), 300) for _ in range(9)]
    rows = []
    for cell, run in enumerate(runs):
        blocks = Blocks(0)
        held = [b for part in (run[:7], run[7:]) if len(part) for b in blocks.add(8 * cell, part)]
        rows += [r for b in [*held, *blocks.rest()] for r in b.to_pylist()]
    # As the exchange of a round delivers them: by cell and first key.
    goal = 1  # all blocks to one cell
    rows = sorted((r | {"cell": goal} for r in rows), key=lambda r: r["first"])
    schema = pa.schema([("cell", pa.int32()), *((c, pa.binary()) for c in ("first", "keys", "ids", "known", "counts"))])
    batches = [pa.RecordBatch.from_pylist(rows[k : k + 4], schema) for k in range(0, len(rows), 4)]
    merged = joined([run for cell, run in merge_blocks(iter(batches), True)])
    want = {}
    for run in runs:
        for key, i, known, n in zip(run.keys, run.ids, run.known, run.counts, strict=True):
            best, any_known, total = want.get(key, (np.iinfo(np.int64).min, False, 0))
            want[key] = (max(best, i), any_known or known, total + n)
    got = {k: (i, bool(known), n) for k, i, known, n in zip(merged.keys, merged.ids, merged.known, merged.counts, strict=True)}
    assert len(got) == len(merged) and got == {k: (i, bool(b), n) for k, (i, b, n) in want.items()}
    assert [k.ljust(48, b"\0") for k in merged.keys] == sorted(k.ljust(48, b"\0") for k in want)


def test_small_blocks_on_spark(docs_of, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK", 5)
    rows = [(i, f"t{i * i % 401}") for i in range(1500)] + ROWS
    assert got(exact_duplicates(docs_of(rows).repartition(11))) == brute(rows)
