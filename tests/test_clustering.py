import random
from datetime import date

from tarn.operators import clustering


def test_gaps_over_blocks(spark, monkeypatch):
    """Gaps within a block, over one edge and over whole blocks; a dry month, a single pool, and no rows at all."""
    monkeypatch.setattr(clustering, "BLOCK", 5)
    rng = random.Random(4)
    months = {date(2020, m, 1): [rng.random() < share for _ in range(97)] for m, share in ((1, 0.5), (2, 0.05), (3, 0.0), (4, 1.0))}
    months[date(2020, 5, 1)] = [k == 40 for k in range(97)]
    rows, want = [], []
    for month, wet in months.items():
        rows += [(month, k, w, float(1 + k % 3)) for k, w in enumerate(wet)]
        on = [k for k, w in enumerate(wet) if w]
        want += [(month, n + 1, sum(1.0 + k % 3 for k in range(a + 1, b))) for n, (a, b) in enumerate(zip(on, on[1:])) if b > a + 1]
    rng.shuffle(rows)
    kind = "month date, seg_ix long, wet boolean, length_m double"
    assert sorted(tuple(r) for r in clustering.gaps(spark.createDataFrame(rows, kind)).select("month", "gap_ix", "gap_m").collect()) == sorted(want)
    assert clustering.gaps(spark.createDataFrame([], kind)).collect() == []
