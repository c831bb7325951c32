"""Leaks, mixtures and shared spans against brute force."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomset.llm import leaks, mix, spans

WORDS = "the lamp of a quiet river turns slowly under bridges while old sailors count seven copper coins beside their painted boats".split()


def sentence(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ed"]) for _ in range(n))


def words(s):
    return re.findall(r"[^\W_]+", re.sub(r"\\[^\W\d_]+", " ", s).lower())


def leak_truth(docs, items, n):
    runs = lambda t: {tuple(w[k : k + n]) for w in [words(t)] for k in range(len(w) - n + 1)}
    return {(i, d) for i, x in items if x for d, t in docs if t and i is not None and d is not None and runs(x) & runs(t)}


def leak_case():
    r = random.Random(3)
    items = [(k, sentence(r, r.randint(10, 40))) for k in range(20)] + [(20, None), (21, ""), (22, "too short"), (None, sentence(r, 30)), (3, sentence(r, 20))]
    docs = []
    for k in range(120):
        w = words(items[k % 20][1])
        n, at = r.randint(5, len(w)), 0
        part = w[at : at + n] if k % 2 else w[-n:]
        text = " ".join(f"\\emph{{{x}}}" if r.random() < 0.1 else x.upper() if r.random() < 0.1 else x for x in part)
        text = text.replace(" ", "\n% ", 1) if k % 3 == 0 else text.replace(" ", " -- ", 2)
        docs.append((k, sentence(r, r.randint(0, 60)) + " ÄÖ. " + text + (", " if k % 5 else "x") + sentence(r, 30)))
    return docs + [(500, None), (501, ""), (502, "\\"), (None, items[0][1]), (503, items[4][1]), (503, items[4][1]), (504, sentence(r, 300_000) + " " + items[5][1])], items


def test_leaks(spark):
    docs, items = leak_case()
    d = spark.createDataFrame([(a, b, 7) for a, b in docs], "doc_id bigint, text string, item_id int")
    e = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in leaks.leaked_items(d, e).collect()}
    want = leak_truth(docs, items, 13)
    assert got == want and len(want) > 20
    assert leaks.leaked_items(d.limit(0), e).count() == 0 and leaks.leaked_items(d, e.limit(0)).count() == 0


def test_leaks_in_tiny_blocks(monkeypatch):
    """A block with fewer hits than a passage needs."""
    docs, items = leak_case()
    own = [(i, x) for i, x in items if x and i is not None]
    index = leaks.Index([i for i, _ in own], [x for _, x in own], leaks.Settings())
    for k in range(40):
        doc, item, n, *_ = index.search([docs[k][1]])
        assert {(index.ids[i], k) for i, m in zip(item, n) if m >= 13} == leak_truth([docs[k]], own, 13)
    assert len(index.search([""])[0]) == 0


def near_truth(text, item, n, edits):
    """Whether ``n`` consecutive words of the item align with the text within ``edits``, by a full table."""
    x, w = " " + "".join(f"{v} " for v in words(text)), words(item)
    for k in range(len(w) - n + 1):
        y = " " + "".join(f"{v} " for v in w[k : k + n])
        row = [0] * (len(x) + 1)
        for c in y:
            new = [row[0] + 1]
            for j, e in enumerate(x):
                new.append(min(row[j] + (c != e), row[j + 1] + 1, new[j] + 1))
            row = new
        if min(row) <= edits:
            return True
    return False


def edited_case():
    r = random.Random(5)
    items = [(k, sentence(r, 26)) for k in range(6)]
    docs = []
    for k in range(40):
        w = items[k % 6][1].split()
        n = r.randint(9, 20)
        at = r.randrange(26 - n)
        part = " ".join(w[at : at + n])
        for _ in range(k % 4):
            p = r.randrange(len(part))
            part = r.choice([part[:p] + part[p + 1 :], part[:p] + "q" + part[p:], part[:p] + "q" + part[p + 1 :]])
        docs.append((k, sentence(r, 20) + "! " + part + " - " + sentence(r, 20)))
    return docs, items


def test_edits_within_the_budget_are_found_and_no_others(spark):
    docs, items = edited_case()
    truth = {(i, d) for d, t in docs for i, x in items if near_truth(t, x, 13, 1)}
    rows = leaks.leaked(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = {(r.item_id, r.doc_id) for r in rows}
    assert got == truth and 8 < len(truth) < 35 and len(rows) == len(got)
    assert any(r.words < 13 for r in rows) and all(r.near_words >= max(13, r.words) for r in rows)


def test_ten_words_are_no_passage():
    text = sentence(random.Random(5), 40)
    index = leaks.Index([1], [text], leaks.Settings())
    assert not len(index.search(["before " + " ".join(text.split()[10:20]) + " after"])[0])


def test_items_and_places_in_slices(spark, monkeypatch):
    docs, items = leak_case()
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = leak_truth(docs, items, 13)
    monkeypatch.setattr(leaks, "MAX_ITEM_CHARS", 900)
    assert {tuple(r) for r in leaks.leaked_items(d, e).collect()} == want
    own = [(i, x) for i, x in items if x and i is not None]
    index = leaks.Index([i for i, _ in own], [x for _, x in own], leaks.Settings())
    texts = [t for _, t in docs]
    whole = [x.tolist() for x in index.search(texts)]
    for most in (1, 40, 3000):
        monkeypatch.setattr(leaks, "MOST_PLACES", most)
        assert [x.tolist() for x in index.search(texts)] == whole


def shared_truth(docs, n):
    w = {}
    for d, t in docs:
        if d is not None and t is not None:
            for k in range(len(t) - n + 1):
                w.setdefault(t[k : k + n], set()).add(d)
    return {(a, b) for v in w.values() for a in v for b in v if a < b}


def span_case():
    r = random.Random(9)
    base = [". ".join(sentence(r, r.randint(3, 25)) for _ in range(14)) + (".\n" if k % 2 else "é") for k in range(12)]
    docs = []
    for k in range(150):
        a, n = r.choice(base), r.choice([250, 390, 398, 399, 400, 401, 402, 420, 500, 900])
        at = r.randrange(max(1, len(a) - n))
        docs.append((k, chr(0x3B1 + k % 20) * r.randint(0, 90) + sentence(r, 30) + "#" + a[at : at + n] + "#" + sentence(r, 20)))
    same = docs[0][1]
    return docs + [(200, same), (201, same), (202, None), (203, ""), (None, same), (204, "z" * 3000), (205, "z" * 2000 + "q"), (206, "x" * 399), (207, "x" * 399), (208, "ab " * 400), (209, "ab " * 500), (0, same)]


@pytest.mark.parametrize("hot", [200, 1])
def test_shared_spans(spark, hot):
    docs = span_case()
    df = spark.createDataFrame([(a, b, "clash") for a, b in docs], "doc_id bigint, text string, t string")
    op = spans.SharedSpans(df, spans.Settings(hot=hot))
    want = shared_truth(docs, 400)
    assert {tuple(r) for r in op.pairs().collect()} == want and len(want) > 40
    share = {r.doc_id: r for r in op.share().collect()}
    inside = {d for p in want for d in p}
    assert all((share[d].shared_chars >= 400) == (d in inside) for d in share)
    assert share[204].shared_chars == 3000 and share[203].shared_chars == 0
    kept = {r.doc_id: r.text for r in op.kept().collect()}
    assert kept[201] == "" and kept[206] == "x" * 399
    groups = {}
    for d, x in docs:
        if d is not None and x is not None:
            for k in range(len(x) - 399):
                groups.setdefault(x[k : k + 400], set()).add(d)
    classes = {(min(g), len(g), d) for g in groups.values() if len(g) > 1 for d in g}
    copies = {(0, 3, d) for d in (0, 200, 201)}
    assert {tuple(r) for r in op.classes().collect()} == classes | copies
    later = {d: set() for d in share}
    for d, x in docs:
        if d is not None and x is not None:
            for k in range(len(x) - 399):
                if min(groups[x[k : k + 400]]) < d:
                    later[d].update(range(k, k + 400))
    assert {r.t: r for r in op._parts(1).groupBy("t").agg(F.count("*")).collect()}.keys() <= {r.t for r in op.members.collect()}
    assert {d for d in kept if kept[d] != dict(docs)[d]} <= {d for d in later if later[d]}
    left = [(d, t) for d, t in kept.items()]
    assert all(len(kept[d]) <= share[d].n_chars for d in kept) and len(shared_truth(left, 400)) < len(want)


@pytest.mark.parametrize(("seed", "hot"), [(1, 3), (7, 10**6), (8, 3), (10, 10**6)])
def test_spans_of_patched_texts(spark, seed, hot):
    """Texts put together of few pieces, so that windows begin and end everywhere: pairs, classes, shares and what is kept, all exact."""
    r, n = random.Random(seed), 40
    alphabet = ("ab. \n", "abcdefgh. \n", "aé日😀. ")[seed % 3]
    base = ["".join(r.choices(alphabet, k=r.randint(30, 160))) for _ in range(6)]
    docs = {}
    for _ in range(60):
        text = ""
        for _ in range(r.randint(1, 4)):
            b = r.choice(base)
            i = r.randrange(len(b))
            text += b[i : r.randint(i, len(b))] if r.random() < 0.7 else "".join(r.choices(alphabet, k=r.randint(0, 60)))
        docs[r.randint(0, 10**6)] = text
    docs |= {10**7 + k: docs[d] for k, d in enumerate(list(docs)[:3])}
    groups, copies = {}, {}
    for d, t in docs.items():
        copies.setdefault(t, set()).add(d)
        for k in range(len(t) - n + 1):
            groups.setdefault(t[k : k + n], set()).add(d)
    whole = [g for g in groups.values()] + [g for t, g in copies.items() if len(t) >= n]
    shared, kept = {}, {}
    for d, t in docs.items():
        at = {k for k in range(len(t) - n + 1) if len(groups[t[k : k + n]]) > 1}
        later = sorted({x for k in at if min(groups[t[k : k + n]]) < d for x in range(k, k + n)})
        shared[d] = len({x for k in at for x in range(k, k + n)})
        kept[d] = "" if len(t) >= n and min(copies[t]) < d else spans.without(t, [(x, x + 1) for x in later])
    op = spans.SharedSpans(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), spans.Settings(length=n, reach=12, hot=hot))
    assert {tuple(x) for x in op.pairs().collect()} == {(a, b) for g in whole for a in g for b in g if a < b}
    assert {tuple(x) for x in op.classes().collect()} == {(min(g), len(g), d) for g in whole if len(g) > 1 for d in g}
    assert {x.doc_id: x.shared_chars for x in op.share().collect()} == shared
    assert {x.doc_id: x.text for x in op.kept().collect()} == kept


def test_a_passage_in_many_texts_is_linear_work(spark):
    """Neither pairs nor texts are multiplied: what is found grows like the number of texts, hot or not."""
    r = random.Random(3)
    passage, rows = sentence(r, 110), {}
    assert 600 < len(passage)
    own = lambda: " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(30))  # nothing in common by chance
    for n in (1000, 4000):
        docs = [(k, f"{own()} # {passage} # {own()}") for k in range(n)] + [(n + k, f"{k} " + "alone. " * 80) for k in range(2)]
        op = spans.SharedSpans(spark.createDataFrame(docs, "doc_id bigint, text string"), spans.Settings(hot=500))
        rows[n] = op.found.count()
        share = op.share().where(f"doc_id < {n}").agg(F.min("shared_chars"), F.max("shared_chars")).first()
        assert share[0] >= len(passage) + 4 and share[1] < len(passage) + 20
        assert op.classes().where(f"first_id = 0 and n_docs = {n}").count() == n
    assert rows[4000] < 4.4 * rows[1000]


def test_sieve(spark):
    rows = spark.range(-5000, 5000).toDF("k")
    ids = rows.where("k % 97 = 0")
    got = {r.k for r in spans.sieved(rows, "k", ids).collect()}
    assert {r.k for r in ids.collect()} <= got and len(got) < 1500
    assert spans.sieved(rows, "k", rows.limit(0)).count() == 0 and spans.sieved(rows, "k", rows).count() == 10_000


def test_no_documents(spark):
    op = spans.SharedSpans(spark.createDataFrame([], "doc_id bigint, text string"))
    assert op.pairs().count() == 0 and op.share().count() == 0 and op.kept().count() == 0


def test_reach_must_fit():
    with pytest.raises(ValueError, match="reach"):
        spans.Settings(length=100).span  # noqa: B018


def test_without():
    text = "One two. Three four. Five six.\nSeven."
    assert spans.without(text, [(9, 21)]) == "One two. Five six.\nSeven."
    assert spans.without(text, [(10, 21)]) == text and spans.without(text, []) == text and spans.without("", [(0, 5)]) == ""


def test_sainte_lague():
    r = random.Random(1)
    for _ in range(400):
        k, n = r.randint(1, 6), r.randint(0, 80)
        w, c, got = [r.choice([0, r.random(), 0.25]) for _ in range(k)], [r.randint(0, 30) for _ in range(k)], [0] * k
        for _ in range(n):
            q = [w[i] / (2 * got[i] + 1) if got[i] < c[i] and w[i] > 0 else -1 for i in range(k)]
            if max(q) < 0:
                break
            got[q.index(max(q))] += 1
        assert mix.sainte_lague(w, n, c) == got, (w, n, c)


TARGET = "source string, target_share double, max_repeats int"


def test_mixture(spark):
    r = random.Random(2)
    docs = [(k, r.choice("aaaab") if k % 9 else r.choice(["c", None, "z"]), sentence(r, r.randint(1, 60))) for k in range(1500)] + [(9000, "a", None), (9001, "a", ""), (None, "a", "words"), (5, "a", "twice")]
    d = spark.createDataFrame([(a, b, c, 1) for a, b, c in docs], "doc_id bigint, source string, text string, shard int")
    t = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 3), ("c", 0.2, 4), ("absent", 0.1, 2), (None, 0.5, 1), ("z", None, 2)], TARGET)
    m = mix.Mixture(d, t, mix.Settings(block=16, least_shards=4))
    s = {x.source: x for x in m.shares().collect()}
    assert abs(s["a"].actual_share - 4 / 9) < 0.02 and abs(s["b"].actual_share - 3 / 9) < 0.02 and abs(s["c"].actual_share - 2 / 9) < 0.02
    assert s["absent"].mixed_tokens == s["z"].mixed_tokens == s[None].mixed_tokens == 0 and s[None].available_tokens > 0
    assert all(x.most_repeats <= (x.max_repeats or 0) for x in s.values())
    assert m.chosen().where("repeats < 1 or tokens < 1").count() == 0
    again = mix.Mixture(d, t, mix.Settings(block=16, least_shards=4))
    assert sorted(m.chosen().select(F.coalesce("doc_id", F.lit(-1)), "repeats").collect()) == sorted(again.chosen().select(F.coalesce("doc_id", F.lit(-1)), "repeats").collect())
    with pytest.raises(ValueError, match="several"):
        mix.Mixture(d, t.unionAll(t))
    half = mix.Mixture(d, t, mix.Settings(block=16, least_shards=4, total=3200))
    assert abs(half.shares().agg(F.sum("mixed_tokens")).first()[0] - 3200) < 600


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables here")
def test_shares_reached_on_the_tables(spark):
    """Every source with documents gives its share, among those that have any, and is repeated no more often than it may be."""
    from loomset.llm.queries import p8_shares

    rows = p8_shares(spark, "/root/testdata/sf0.01").collect()
    able = [r for r in rows if r.target_share and r.available_tokens]
    whole = sum(r.target_share for r in able)
    assert able and all(abs(r.actual_share - r.target_share / whole) < 0.005 and r.most_repeats <= r.max_repeats for r in able)
    assert all(r.mixed_tokens == 0 for r in rows if r not in able) and abs(sum(r.actual_share for r in rows) - 1) < 1e-9


def test_mixture_of_nothing(spark):
    d, t = spark.createDataFrame([], "doc_id bigint, source string, text string"), spark.createDataFrame([("a", 1.0, 1)], TARGET)
    assert mix.Mixture(d, t).chosen().count() == 0 and mix.Mixture(d, t).shares().count() == 1
    assert mix.Mixture(spark.createDataFrame([(1, "a", "words")], d.schema), t.limit(0)).chosen().count() == 0


def test_token_counts(spark):
    texts = ["Hello world", "a" * 5000, "", None, "<|endoftext|>", "日本"]
    got = {r.doc_id: r.tokens for r in mix.token_counts(spark.createDataFrame([(k, "s", t) for k, t in enumerate(texts)], "doc_id bigint, source string, text string"), mix.Settings().vocabulary).collect()}
    e = mix.encoder(mix.Settings().vocabulary)
    assert got == {k: len(e.encode_ordinary(t)) if t else 0 for k, t in enumerate(texts)} and e.decode(e.encode_ordinary("日本 x")) == "日本 x"
