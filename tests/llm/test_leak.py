import random

import pytest

from driftline.llm import leak
from driftline.llm.leak import RADIUS, ItemIndex, _joined, leaked_items
from driftline.llm.words import words

VOCAB = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}ord" for i in range(200)]
FILL = [f"filler{i}" for i in range(300)]


def items(r, n=6):
    return [(i, " ".join(r.choice(VOCAB) for _ in range(60))) for i in range(n)]


def test_all_pairs_within_the_radius_are_found():
    r = random.Random(1)
    index = ItemIndex(items(r))
    codes = index.codes(index.words[2][:20] + [r.choice(VOCAB) for _ in range(30)])
    prints = index.fingerprints(codes)
    left, right = index.candidates(prints)
    got = set(zip(left.tolist(), right.tolist(), strict=True))
    mine, theirs = _joined(prints).tolist(), index.prints.tolist()
    want = {(i, j) for i, a in enumerate(mine) for j, b in enumerate(theirs) if (a ^ b).bit_count() <= RADIUS}
    assert got == want and want


def test_lengths_and_alterations():
    r = random.Random(2)
    its = items(r)
    index = ItemIndex(its)

    def doc(n, altered=(), item=0, start=10):
        w = words(its[item][1])[start : start + n]
        for k in altered:
            w[k] = r.choice(FILL)
        return " ".join([r.choice(FILL) for _ in range(20)] + w + [r.choice(FILL) for _ in range(20)])

    assert index.leaked(doc(15)) == [0] and index.leaked(doc(14)) == []
    assert index.leaked(doc(15, [7])) == [0] and index.leaked(doc(20, [6, 12])) == [0]
    assert index.leaked(doc(17, [6, 9])) == [] and index.leaked(doc(40, range(2, 38, 4))) == []
    assert index.leaked(doc(45, [5, 15, 25, 35])) == [0]
    misspelt = its[1][1].split()[:15]
    misspelt[0] = misspelt[0][:-1]
    assert index.leaked(" ".join(misspelt)) == [1]
    both = doc(20) + " " + doc(20, item=3)
    assert index.leaked(both) == [0, 3]


def test_case_markup_and_breaks_do_not_matter():
    its = [(5, "Déjà vu über alle Bäume; the quick brown fox jumps over the lazy dog and then sleeps well.")]
    index = ItemIndex(its)
    assert index.leaked("> **DEJA** vu ueber\n> alle _Baeume_ |the quick| brown\tfox jumps over the lazy dog AND then sleeps") == [5]


def test_random_documents_equal_brute_force(spark):
    r = random.Random(3)
    its = items(r, 4)
    index = ItemIndex(its)
    docs = []
    for k in range(120):
        w = [r.choice(FILL + VOCAB) for _ in range(30)]
        if k % 2:
            i = r.randrange(4)
            src = words(its[i][1])
            a = r.randrange(40)
            part = src[a : a + r.randint(10, 40)]
            for p in range(len(part)):
                if r.random() < 0.07:
                    part[p] = r.choice(FILL)
            w[15:15] = part
        docs.append((k, " ".join(w)))
    want = set()
    for k, text in docs:
        ws = words(text)
        for i, (item_id, _) in enumerate(its):
            if any(index._holds(ws, index.words[i], s) for s in range(-60, len(ws))):
                want.add((k, item_id))
    docs += [(500, None), (501, ""), (502, "short"), (None, None)]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, item_id string")
    assert {tuple(x) for x in leaked_items(df, its).collect()} == want and len(want) > 15
    assert leaked_items(df, []).count() == 0 and leaked_items(df, [(1, None), (2, "too short")]).count() == 0
    assert leaked_items(df.limit(0), its).count() == 0


@pytest.mark.parametrize("length", [15, 20, 29, 44])
def test_recall_against_brute_force_at_the_most_alterations(length):
    r = random.Random(length)
    its = items(r, 12)
    index = ItemIndex(its)
    found = held = 0
    for _ in range(400):
        i = r.randrange(len(its))
        start = r.randrange(60 - length + 1)
        w = words(its[i][1])[start : start + length]
        for k in r.sample(range(1, length - 1), length // 10):
            w[k] = r.choice(FILL + VOCAB)
        ws = [r.choice(FILL) for _ in range(10)] + w + [r.choice(FILL) for _ in range(10)]
        want = {its[j][0] for j in range(len(its)) if any(index._holds(ws, index.words[j], s) for s in range(-60, len(ws)))}
        got = set(index.leaked(" ".join(ws)))
        assert got <= want
        held += len(want)
        found += len(got)
    assert held >= 400 and found / held >= 0.99


def test_more_items_than_a_pass_holds_scan_the_corpus_once(spark, monkeypatch):
    r = random.Random(5)
    its = items(r, 12)
    docs = [(k, " ".join([r.choice(FILL) for _ in range(15)] + (words(its[k % 12][1])[5:25] if k % 3 else []))) for k in range(60)] + [(99, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    once = {tuple(x) for x in leaked_items(df, its).collect()}
    monkeypatch.setattr(leak, "PASS_WORDS", 150)
    assert {tuple(x) for x in leaked_items(df, iter(its)).collect()} == once and len(once) == 40
    assert leak.suspects(df, its).count() == 40
    monkeypatch.setattr(leak, "SCAN_WORDS", 400)
    assert {tuple(x) for x in leaked_items(df, iter(its)).collect()} == once
