import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerforge.operators.units import changepoints, delivered_amounts, read_pack, read_units


def best_cost(y, penalty):
    """The optimum of all segmentations, by dynamic programming without pruning."""
    n = len(y)
    f = [-penalty] + [0.0] * n
    for t in range(1, n + 1):
        f[t] = min(f[s] + ((y[s:t] - y[s:t].mean()) ** 2).sum() + penalty for s in range(t))
    return f[n]


def cost(y, ends, penalty):
    total, a = -penalty, 0
    for b in ends:
        total, a = total + ((y[a:b] - y[a:b].mean()) ** 2).sum() + penalty, b
    return total


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0.0, math.log(12), math.log(10), math.log(72)]) | st.floats(-3, 3), min_size=1, max_size=25), st.sampled_from([0.004, 0.1, 1.0]))
def test_segmentation_is_the_optimum(values, penalty):
    y = np.array(values)
    assert cost(y, changepoints(y, penalty), penalty) == pytest.approx(best_cost(y, penalty), abs=1e-9)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("l X 36", (None, 0, 36, 36, None)),
        ("12x500 G / pcs", ("g", 500, 12, 0, "pcs")),
        ("DOZEN: 6x12x25gr", ("g", 25, 72, 12, "12")),
        ("12 BOX X 6 PCS @ 0,25 KG", ("g", 250, 72, 6, None)),
        ("KRT/48/1/4 kg SAT. DOZEN", ("g", 250, 48, 0, "12")),
        ("KRT/6/2 L", ("ml", 2000, 6, 0, None)),
        ("KRT/24/4O0 gr (lsn)", ("g", 400, 24, 0, "12")),
        ("CURAH ZAK 25 kg", ("g", 0, 0, 0, "#25000")),
        ("ons (curah)", ("g", 0, 0, 0, "#100")),
        ("ISI 24 BH/DUS", (None, 0, 24, 0, None)),
        ("BONAXA TEPUNG BERAS BLACK 04 LUSIN: 6 BOX X 12 PCS @ 150gram", ("g", 150, 72, 12, "12")),
        ("36 X l ONS / PCS", ("g", 100, 36, 0, "pcs")),
        ("TANEXI BERAS CURAH ons", ("g", 0, 0, 0, "#100")),
        ("6 BOX X 12 PCS @ l/4 L", ("ml", 250, 72, 12, None)),
        ("lihat lampiran", (None, 0, 0, 0, None)),
        ("", (None, 0, 0, 0, None)),
    ],
)
def test_packs(text, want):
    assert read_pack(text) == want


COLS = "id bigint, kode_material string, kemasan string, nama_produk string, qty decimal(16,4), harga decimal(16,4), disc_1 decimal(16,2), disc_2 decimal(16,2), disc_3 decimal(16,2), disc_4 decimal(16,2), disc_5 decimal(16,2), jumlah decimal(16,2), source string, gross int"


def line(i, pack, qty, price, amount, code="A", name="X", disc=0):
    from decimal import Decimal as D

    d = lambda x: None if x is None else D(str(x))
    return (i, code, pack, name, d(qty), d(price), d(disc), None, None, None, None, d(amount), "clash", 7)


def test_units_named_and_proved(spark):
    rows = [
        line(1, "12 X 250 ML", 5, 100, 500),  # pieces
        line(2, "12 X 250 ML", 5, 100, 6000),  # cartons of 12 or dozens
        line(3, "24 X 100 GR", 2, 10, 470, disc=10),  # cartons of 24, discount given back
        line(4, "24 X 100 GR / LSN", 2, None, None),  # named dozens
        line(5, "24 X 100 GR", 2, None, None),  # neither
        line(6, "24 PCS", 0, 10, 0),
        line(7, None, 3, 10, 30, name=None),
        line(8, "CURAH SAK 25 KG", 2, 10, 500, code=None),
        line(9, "72 PCS", 3, 10, 2160),
        line(9, "72 PCS", 3, 10, 2160),
    ]
    got = delivered_amounts(spark.createDataFrame(rows, COLS)).collect()
    want = {1: ("ml", 1250), 2: ("ml", 15000), 3: ("g", 4800), 4: ("g", 2400), 8: ("g", 50000), 9: ("pcs", 216)}
    assert {r.id: (r.base_unit, r.base_qty) for r in got} == want
    assert sum(r.id == 9 for r in got) == 2
    assert delivered_amounts(spark.createDataFrame([], COLS)).count() == 0


def test_one_history_over_many_batches(spark):
    """A history that fills many Arrow batches and partitions has the units of its lines all the same."""
    n = 30_000
    pdf = pd.DataFrame({"id": range(n)})
    from pyspark.sql import functions as F

    base = spark.range(n).select(F.col("id"), F.lit("A").alias("kode_material"), F.lit("24 X 10 GR").alias("kemasan"), F.lit("X").alias("nama_produk"), F.lit(2).cast("decimal(16,4)").alias("qty"), F.lit(7).cast("decimal(16,4)").alias("harga"), *[F.lit(0).cast("decimal(16,2)").alias(f"disc_{i}") for i in range(1, 6)], F.expr("case when id % 1000 < 500 then 14 when id % 3 = 0 then 168 else 336 end").cast("decimal(16,2)").alias("jumlah"))
    got = delivered_amounts(base).toPandas().set_index("id").base_qty
    want = pdf.id.map(lambda i: 20 if i % 1000 < 500 else 240 if i % 3 == 0 else 480)
    assert (got.sort_index() == want).all()


def test_the_search_decides_in_noisy_histories():
    """Amounts that are 5 % off around their unit: segments read nearly every line, rows on their own only some."""
    rng = np.random.default_rng(5)
    n = 3000
    factor = np.repeat(rng.permutation([1.0, 24.0, 12.0] * 5), n // 15)
    pdf = pd.DataFrame({"id": range(n), "source": "A", "kemasan": "24 X 10 GR", "nama_produk": "X", "qty": 2.0, "harga": 7.0})
    pdf["gross"] = 14.0 * factor * np.exp(rng.normal(0, 0.05, n))
    read = lambda **how: read_units(pdf, 0.02, **how)[0].set_index("id").unit_factor.reindex(range(n))
    assert (read() == factor).mean() > 0.99
    assert (read(penalty=0.0) == factor).mean() < 0.5  # every line a segment of its own


def test_segments_run_on_over_batches():
    """A segment that a batch cuts is finished with the next one: three noisy lines alone have no level, with the rest they have."""
    y = [1.03, 0.96, 1.02, 0.99] * 100
    pdf = pd.DataFrame({"id": range(400), "source": "A", "kemasan": "24 X 10 GR", "nama_produk": "X", "qty": 2.0, "harga": 7.0, "gross": [14.0 * v for v in y]})
    made, done = read_units(pdf.iloc[:203], 0.02, last=False)
    rest, end = read_units(pdf.iloc[done:], 0.02)
    assert done == 0 and len(made) + len(rest) == 400 and end == 400 - done
    assert set(pd.concat([made, rest]).unit_factor) == {1.0}
