import random
from collections import Counter

import corpora
from punctua.llm import substring_dedup as operator


def expected(texts, window):
    split = [corpora.WORD.findall(t or "") for t in texts]
    counts = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for words in split:
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            if counts[tuple(words[i:i + window])] > 1:
                keep[i:i + window] = [False] * window
        out.append((len(words), keep.count(False), corpora.sha(" ".join(w for w, k in zip(words, keep) if k))))
    return out


def check(spark, texts, window=35, edge=8):
    rows = operator.repeated_passages(corpora.frame(spark, texts).repartition(5), window, edge).collect()
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}
    assert [found[i] for i in range(len(texts))] == expected(texts, window)


def test_passages_match_brute_force(spark):
    rng = random.Random(12)
    passages = [corpora.prose(rng, n) for n in (20, 34, 35, 36, 50, 90, 400)]
    texts = corpora.odd_texts(rng)
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(corpora.prose(rng, rng.randint(0, 60)))
            if rng.random() < 0.6:
                words = rng.choice(passages).split()
                a = rng.randint(0, len(words) // 3)
                parts.append(" ".join(words[a:rng.randint(a, len(words))]))
        texts.append(" ".join(parts))
    texts += [texts[-1]] * 30 + [passages[5]] * 3
    check(spark, texts)


def test_periodic_text_and_small_vocabulary(spark):
    rng = random.Random(13)
    texts = ["a " * 100, "a b " * 40, "a b c " * 20, " ".join(rng.choice("ab") for _ in range(400))]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 80))) for _ in range(60)]
    check(spark, texts)
    check(spark, texts, window=9, edge=3)


def test_near_copies(spark):
    rng = random.Random(14)
    text = corpora.prose(rng, 600)
    check(spark, [text, *corpora.near_copies(rng, text, 25, 8)])


def test_repeated_rows_null_ids_and_empty_table(spark):
    rng = random.Random(15)
    text = corpora.prose(rng, 40)
    rows = operator.repeated_passages(corpora.frame(spark, [text, text, "a b", None], ids=[None, 2, 2, None])).collect()
    assert sorted((r.n_words, r.n_removed) for r in rows) == [(0, 0), (2, 0), (40, 40), (40, 40)]
    assert operator.repeated_passages(corpora.frame(spark, [])).collect() == []
