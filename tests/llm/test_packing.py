import random
import zlib

import corpora
import numpy as np
from punctua.llm import packing as operator
from tokenizers import Tokenizer


def tokenizer():
    return Tokenizer.from_file(operator.tokenizer_path())


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return len(rooms), sorted(rooms)


def test_ids_are_those_of_the_tokenizer():
    rng = random.Random(4)
    ids, whole = operator.TextIds(operator.tokenizer_path()), tokenizer()
    assert ids.engine is not None

    def same(text):
        return np.frombuffer(ids.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids

    alphabet = ["a", "B", "'s", "é", "日本", " ", "  ", "\n", "\n\n", "\t", " \n ", "\xa0", "\x1c", "\x85", "12", "!", "<|endoftext|>", "　", "'LL"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
        assert same(text), repr(text)
    assert np.frombuffer(ids.of("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    assert all(same(f"a{chr(c)} {chr(c)}1") for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x3100 or c % 97 == 0))
    assert all(same(run * 20_000) for run in ("a", " ", "1", "ab", "\n", "!"))


def test_other_tokenizers_are_left_to_the_library(tmp_path):
    import json

    with open(operator.tokenizer_path(), encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "lower.json"
    path.write_text(json.dumps(spec))
    ids = operator.TextIds(str(path))
    assert ids.engine is None
    assert ids.of("The Cat") == operator.TextIds(operator.tokenizer_path()).of("the cat")


def test_plan_is_best_fit_decreasing():
    rng = random.Random(5)
    for capacity in (1, 7, 50, 2048):
        for _ in range(25):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 120))]
            lengths += [rng.choice(lengths)] * rng.randint(0, 60)
            counts = {n: lengths.count(n) for n in set(lengths)}
            runs = operator.plan(counts, capacity)
            filled, placed = {}, 0
            by_length = {}
            for run in sorted(runs):
                by_length.setdefault(run[0], []).append(run)
            for length, found in by_length.items():
                for (_, rank, first, each, offset), stop in zip(found, [r[1] for r in found[1:]] + [counts[length]]):
                    for nth in range(stop - rank):
                        filled.setdefault(first + nth // each, []).append((offset + nth % each * length, length))
                        placed += 1
            assert placed == len(lengths)
            rooms = []
            for parts in filled.values():
                at = 0
                for offset, length in sorted(parts):
                    assert offset == at
                    at += length
                assert at <= capacity
                rooms.append(capacity - at)
            assert (len(rooms), sorted(rooms)) == best_fit_decreasing(lengths, capacity)


def test_round_trip(spark):
    rng = random.Random(6)
    texts = corpora.odd_texts(rng) + [corpora.prose(rng, rng.randint(0, 700)) for _ in range(60)] + ["same text"] * 500
    whole = tokenizer()
    rows = operator.pack(corpora.frame(spark, texts).repartition(6)).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for doc_id, pieces in by_doc.items():
        ids = np.array(whole.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0], "<u4")
        pieces.sort(key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert sum(p.length for p in pieces) == len(ids)
        assert all(p.length == 2048 for p in pieces[1:])
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert len(by_sequence) == best_fit_decreasing([r.length for r in rows], 2048)[0]


def test_empty_table_and_repeated_rows(spark):
    assert operator.pack(corpora.frame(spark, [])).collect() == []
    rows = operator.pack(corpora.frame(spark, [None, "", "a"], ids=[None, 1, 1])).collect()
    assert sorted((r.length, r.offset) for r in rows)[0][0] == 1 and len(rows) == 3
