import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerforge.llm import leaks, mixing, queries, toxic

# ---- leaks --------------------------------------------------------------------------------------------------


def made_items(n=40, seed=1):
    r = random.Random(seed)
    common = "the of a on in by is to with when since under over before".split()
    words = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4))) for _ in range(900)]
    return [(i, " ".join(r.choice(words) if r.random() < 0.6 else r.choice(common) for _ in range(r.randint(40, 80)))) for i in range(n)]


def noise(words, r, every):
    out = list(words)
    for i in range(r.randrange(every), len(out), every):
        out[i] = r.choice(["the", "xyzzy", out[i][:-1] + "q"])
    return out


def test_planted_passages_are_found_and_short_ones_not():
    items, r = made_items(), random.Random(2)
    index = leaks.Index(items, 5, 3, 12, 2)
    filler = lambda n: [f"w{r.randrange(500)}x" for _ in range(n)]
    docs, want = [], set()
    for d in range(300):
        k = r.randrange(len(items))
        w = items[k][1].split()
        if d % 3 == 0:
            a = r.randrange(len(w) - 20)
            body = noise(w[a : a + 20], r, 9)
            want.add((d, k))
        elif d % 3 == 1:
            a = r.randrange(len(w) - 7)
            body = w[a : a + 7]
        else:
            body = []
        docs.append(" ".join([*filler(30), *body, *filler(30)]).upper() if d % 2 else ", ".join([*filler(30), *body, *filler(30)]))
    got = set(leaks.scan(list(range(300)), docs, index).itertuples(index=False, name=None))
    assert got == want


def test_two_changed_words_of_twelve_and_misread_items_are_found():
    items, r = made_items(), random.Random(3)
    index = leaks.Index(items, 5, 3, 12, 2)
    filler = lambda n: [f"w{r.randrange(500)}x" for _ in range(n)]
    misread = lambda w: w[:2] + ("q" if w[2] != "q" else "x") + w[3:] if len(w) > 3 else "xyzzy"
    docs, want = [], set()
    for a in range(12):
        for b in range(a):
            k = r.randrange(len(items))
            words = items[k][1].split()
            weight = [index.rare[w] for w in words]
            # the check also asks for a share of the weight, which stretches with rare words changed may miss
            fit = [i for i in range(len(words) - 11) if (weight[i + a] + weight[i + b]) <= 0.25 * sum(weight[i : i + 12])]
            if fit:
                at = r.choice(fit)
                body = words[at : at + 12]
                body[a], body[b] = "xyzzy", "plugh"
                want.add((len(docs), k))
                docs.append(" ".join([*filler(30), *body, *filler(30)]))
    for k, (_, t) in enumerate(items):
        words = t.split()
        for every, change in ((5, lambda w: "xyzzy"), (5, misread), (2, lambda w: misread(w) if len(w) > 3 else w)):
            want.add((len(docs), k))
            docs.append(" ".join([*filler(10), *[change(w) if i % every == 0 else w for i, w in enumerate(words)], *filler(10)]))
    got = set(leaks.scan(list(range(len(docs))), docs, index).itertuples(index=False, name=None))
    assert got == want


def test_index_loses_no_window_within_the_radius():
    items = made_items(15)
    index = leaks.Index(items, 5, 3, 12, 2)
    r = np.random.default_rng(4)
    base = index.prints[r.integers(0, len(index.prints), 400)]
    for _ in range(3):
        base = base ^ (np.uint64(1) << r.integers(0, 64, len(base)).astype(np.uint64))
    i, j = index.hits(base)
    got = set(zip(i.tolist(), j.tolist()))
    want = {(a, b) for a in range(len(base)) for b in np.flatnonzero(np.bitwise_count(base[a] ^ index.prints) <= 3).tolist()}
    assert got == want


def test_number_formats_and_words():
    assert leaks.words_of("Rp 4.964.711, on 07/07/2025 - Diam-diam 8ecau5e") == leaks.words_of("rp 4,964,711 on 07.07.2025 diam diam because")
    assert leaks.words_of("") == []


def test_portions():
    assert list(leaks.portions([])) == []
    assert list(leaks.portions([5, 5, 5, 100, 1, 1], 10)) == [(0, 2), (2, 3), (3, 4), (4, 6)]


def test_leak_edges(spark):
    w = [f"kata{c}" for c in "abcdefghijklmnopqrst"]
    items = [(1, " ".join(w)), (2, ""), (3, None), (4, "dua kata"), (5, " ".join(w))]
    docs = spark.createDataFrame([(1, " ".join(w[2:16])), (2, None), (3, ""), (4, "x dua kata y"), (5, " ".join(w[2:12])), (None, " ".join(w)), (6, "z " * 200_000 + " ".join(w)), (1, " ".join(w))], "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    got = sorted(tuple(r) for r in leaks.find_leaks(docs, items).distinct().collect())
    assert got == [(1, 1), (1, 5), (4, 4), (6, 1), (6, 5)]
    assert leaks.find_leaks(docs, []).count() == 0
    assert leaks.find_leaks(docs.where("false"), items).count() == 0


def test_leaks_of_the_tables(spark, sf):
    """No pair without a shared run of words is reported, and every exact run of twelve is."""
    items = pd.read_parquet(f"{sf}/eval_items.parquet")
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    runs = {}
    for i, t in zip(items.item_id, items.text):
        w = leaks.words_of(t)
        for k in range(len(w) - 11):
            runs.setdefault(tuple(w[k : k + 12]), set()).add(i)
    exact = {(d, i) for d, t in zip(docs.doc_id, docs.text) for w in [leaks.words_of(t)] for k in range(len(w) - 11) for i in runs.get(tuple(w[k : k + 12]), ())}
    got = {tuple(r) for r in queries.p6_found(spark, sf).collect()}
    assert exact <= got and len(got) <= len(exact) + max(5, len(exact))
    assert queries.p6_report(spark, sf).count() == len({i for _, i in got})


# ---- mixing -------------------------------------------------------------------------------------------------


def sizes(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, h bigint")


def drawn(s, plan):
    return {r.doc_id: r.repeats for r in mixing.draw(s, plan).collect()}


def test_thresholds_against_a_sort(spark):
    r = random.Random(9)
    rows = [(i, r.choice("aab"), r.randrange(1, 300), r.getrandbits(56)) for i in range(3000)]
    s = sizes(spark, rows)
    plans = mixing.plan_mix(s, [("a", 0.3, 2), ("b", 0.7, 3), ("none", 0.5, 9), (None, 1.0, 1)], (0.3, 1.0))
    tokens = {x: sum(n for _, q, n, _ in rows if q == x) for x in "ab"}
    last = None
    for p in plans:
        got = drawn(s, p)
        for src, share in (("a", 0.3), ("b", 0.7)):
            need = round(p.budget * share)
            full, rest = min(need // tokens[src], p.caps[src]), 0
            rest = need - full * tokens[src]
            acc = 0
            for _, _, n, h in sorted((x for x in rows if x[1] == src), key=lambda x: x[3]):
                if acc + n > rest:
                    edge = n
                    break
                acc += n
            else:
                edge = 0
            have = sum(got.get(i, 0) * n for i, q, n, _ in rows if q == src)
            assert abs(have - need) <= max(edge, 1)
            assert max((got.get(i, 0) for i, q, _, _ in rows if q == src), default=0) <= p.caps[src]
        if last is not None:
            assert all(got.get(i, 0) >= k for i, k in last.items())  # nested
        last = got


def test_mix_edges(spark):
    empty = sizes(spark, [])
    assert drawn(empty, mixing.plan_mix(empty, [("a", 1.0, 1)])[0]) == {}
    assert mixing.plan_mix(empty, [])[0].budget == 0 and drawn(empty, mixing.plan_mix(empty, [])[0]) == {}
    same = sizes(spark, [(i, "a", 10, 77) for i in range(20)] + [(99, "a", 0, 5), (100, "b", 10, 1)])
    p = mixing.plan_mix(same, [("a", 0.5, 1), ("b", 0.5, 2)])[0]
    assert p.budget == 40 and drawn(same, p) in ({100: 2}, {**{i: 1 for i in range(20)}, 100: 2})  # equal hashes go together
    docs = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, None, "x"), (4, "a", "Halo dunia 123")], "doc_id bigint, source string, text string").withColumn("h", F.lit("clash")).withColumn("n_tokens", F.lit(-1))
    assert {r.doc_id: r.n_tokens > 0 for r in mixing.token_sizes(docs).collect()} == {1: False, 2: False, 4: True}


def test_hot_source_and_report(spark, sf):
    rep = queries.p7_report(spark, sf).toPandas()
    full = rep[rep.budget == rep.budget.max()]
    live = full[full.source_tokens > 0]
    assert (live.most_repeats <= live.max_repeats).all()
    assert full.actual_share.sum() == pytest.approx(1.0)
    want = live.target_share / live.target_share.sum()
    assert np.allclose(live.actual_share, want, atol=0.02)
    assert (full[full.source_tokens == 0].actual_share == 0).all()
    mix = queries.p7_mix(spark, sf).toPandas()
    assert (mix.n_tokens * mix.repeats).sum() == full.drawn_tokens.sum() and not mix.doc_id.duplicated().any()


def test_a_source_that_may_not_be_drawn(spark):
    sizes = spark.createDataFrame([(i, "ab"[i % 2], 10, i << 40) for i in range(100)], "doc_id bigint, source string, n_tokens bigint, h bigint")
    plan = mixing.plan_mix(sizes, [("a", 0.5, 0), ("b", 0.3, 2), ("c", 0.2, None)])[0]
    drawn = mixing.draw(sizes, plan).collect()
    assert {r.source for r in drawn} == {"b"} and sum(r.repeats for r in drawn) == 100


# ---- toxic --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("w", ["k3par4t", "b.r.e.n.g.s.e.k", "brrrrrengsek", "ba​jingan", "b0d0h", "BODOH", "p-i-gs", "assho*e", "p*g", "аsshоles", "s1nt1ng", "i d i o t", "bugilmu"])
def test_disguises(w):
    t = toxic.tokens(f"woi {w}, diam")
    assert len(t) == 3 and t[1] in toxic._PLAIN


@pytest.mark.parametrize(("text", "want"), [("PIG-88412 dus", ["#", "dus"]), ("[12:30] admin: 12 dus", ["admin", "#", "dus"]), ("", []), ("A4 1kg x2", None)])
def test_tokens_left_alone(text, want):
    got = toxic.tokens(text)
    assert want is None or got == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-4, 4).map(float), max_size=14))
def test_segments_hold_the_best_one(scores):
    best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
    got = toxic.segments(scores)
    assert max((s for *_, s in got), default=0) == max(best, 0)
    assert all(abs(sum(scores[a:b]) - s) < 1e-9 and s > 0 for a, b, s in got)
    assert all(got[i][1] <= got[i + 1][0] for i in range(len(got) - 1))


def corpus(spark, n=1200, seed=3):
    r = random.Random(seed)
    clean = ["truk dari kelung baru sampai", "stok makanan anjing sudah masuk", "harga kikir bastard berubah", "mohon konfirmasi jadwal kirim", "jenis kelamin sex pada formulir", "lipstik nude dikirim", "racun tikus untuk membunuh hama"]
    bad = ["dasar dungu kamu kerja begini saja tidak becus", "semua orvani itu pencuri sejak lahir usir saja", "malam ini temani saya bugil di hotel"]
    rows, labels = [], []
    for i in range(n):
        s = r.choices(clean, k=4)
        toxic_one = r.random() < 0.1
        if toxic_one:
            s.insert(r.randrange(4), r.choice(bad))
        rows.append((i, r.choice(["chat", "mail"]), ". ".join(s), toxic_one))
        if r.random() < (0.6 if toxic_one else 0.1):
            labels.append((i, ("abusive" if toxic_one else "ok") if r.random() < 0.95 else ("ok" if toxic_one else "sexual")))
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string, truth boolean"), spark.createDataFrame(labels, "doc_id bigint, label string")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark, 6000)  # some 900 labels, one in twenty wrong
    table, drift, decay, k = toxic.fit(docs, labels)
    assert all(w not in table for w in ("anjing", "bastard", "nude", "sex", "membunuh"))
    fresh, _ = corpus(spark, 600, seed=8)
    got = toxic.score_documents(fresh, table, drift, decay, k).join(fresh.select("doc_id", "truth"), "doc_id").toPandas()
    flag = got.expectation <= queries.SIGNIFICANT
    assert (flag & got.truth).sum() >= 0.95 * got.truth.sum() and (flag & ~got.truth).sum() <= 0.05 * flag.sum()


def test_toxic_edges(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, None, "dasar bangsat keparat kamu"), (4, "a", "x " * 100_000), (4, "a", "ok")], "doc_id bigint, source string, text string").withColumn("score", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id bigint, label string")
    table, drift, decay, k = toxic.fit(docs, none)
    got = toxic.score_documents(docs, table, drift, decay, k).collect()
    assert len(got) == 5 and {r.doc_id for r in got if r.expectation <= queries.SIGNIFICANT} == {3}
    assert toxic.fit(docs.where("false"), none)[0] is not None
    assert toxic.score_documents(docs.where("false"), table, drift, decay, k).count() == 0


def test_disagreeing_labels(spark):
    lab = spark.createDataFrame([(1, "ok"), (1, "abusive"), (2, "ok"), (2, None), (3, "sexual"), (None, "ok")], "doc_id bigint, label string")
    assert {r.doc_id: r.bad for r in toxic.bad_documents(lab).collect()} == {1: True, 2: False, 3: True}


def test_rates(spark, sf):
    rates = queries.p8_rates(spark, sf).toPandas()
    assert rates.n_documents.sum() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert queries.p8_found(spark, sf).count() == rates.n_bad.sum()


def test_frequent_abuse_stays_listed(spark):
    r = random.Random(6)
    clean = ["stok makanan anjing sudah masuk", "harga kikir bastard berubah", "mohon konfirmasi jadwal kirim", "truk dari kelung baru sampai"]
    rows, labels = [], []
    for i in range(900):
        bad, copy = i % 3 == 0, i % 3 == 1 and i % 2 == 0
        text = f"nota {i}: " + ". ".join(r.choices(clean, k=3)) + (f". dasar {r.choice(['goblok', 'tolol'])} kamu" if bad else "")
        rows.append((i, "chat", "re-upload: dasar keparat kamu" if copy else text))
        if i % 10 == 0 or bad and i % 7 == 0:
            labels.append((i, "abusive" if bad or copy else "ok"))
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    table, drift, decay, k = toxic.fit(docs, spark.createDataFrame(labels, "doc_id bigint, label string"))
    assert {"goblok", "tolol"} <= table.keys() and not {"anjing", "bastard"} & table.keys()
    table, *_ = toxic.fit(docs, spark.createDataFrame([], "doc_id bigint, label string"))
    assert {"goblok", "tolol", "keparat"} <= table.keys()


@pytest.mark.parametrize("decay", [2.0, 2.5, 8.0])
@pytest.mark.parametrize("insult", ["goblok", "g0bl0k", "sebab goblok kamu"])
def test_one_insult_in_a_long_text(spark, decay, insult):
    table, drift = {t: 6.0 for t in toxic._PLAIN} | {"mohon": 2.9}, 2.0
    text = "mohon konfirmasi jadwal kirim hari ini. " * 800
    docs = spark.createDataFrame([(1, "a", insult), (2, "a", text + insult + ". " + text), (3, "a", text)], "doc_id bigint, source string, text string")
    got = {r.doc_id: r for r in toxic.score_documents(docs, table, drift, decay, 4e-4).collect()}
    assert {i for i, r in got.items() if r.expectation <= queries.SIGNIFICANT} == {1, 2}
    assert got[2].n_words > 9000 and got[2].score >= 4.0
