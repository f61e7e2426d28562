import random

import pyarrow as pa

from spanloom.functions.arrow_groups import whole_groups


def test_groups_stay_whole():
    rng = random.Random(1)
    keys = sorted((rng.choice([None, *range(30)]) for _ in range(500)), key=lambda k: (k is not None, k or 0))
    at, batches = 0, []
    while at < len(keys):
        n = rng.choice([0, 1, 7, 60])
        batches.append(pa.RecordBatch.from_pydict({"k": pa.array(keys[at : at + n], pa.int64()), "v": list(range(at, min(at + n, len(keys))))}))
        at += n
    tables = list(whole_groups(iter(batches), ["k"]))
    assert [v for t in tables for v in t["v"].to_pylist()] == list(range(len(keys)))
    seen = [set(t["k"].to_pylist()) for t in tables]
    assert sum(map(len, seen)) == len(set().union(*seen))
