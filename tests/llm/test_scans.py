import random
import re

import corpora
import numpy as np
import pytest
from punctua.llm import license_scan, line_dedup, secret_scan

PATTERNS = (
    ("assign", re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m.group(1)) >= 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 16),
)


def base(text):
    found = [(m.start(), i, kind, m.end()) for i, (kind, p, good) in enumerate(PATTERNS) for m in p.finditer(text or "") if good(m)]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def test_fixed_secret_patterns_match_brute_force(spark):
    rng = random.Random(20)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", ":", "=", " ", "  ", '"', "'", "AKIA", "AKIAABCDEFGHIJKLMN",
            "0123456789abcdef0", "deadbeef", "x", "éß", "longenoughvalue12", "\n", ".", "ſecret", "toKen"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)] + corpora.odd_texts(rng)
    rows = {r.doc_id: r for r in secret_scan.summary(secret_scan.scan(corpora.frame(spark, texts))).collect()}
    for i, text in enumerate(texts):
        spans = base(text)
        assert rows[i].base_sha256 == corpora.sha(",".join(spans)), text
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == tuple(
            sum(s.startswith(kind) for s in spans) for kind in ("assign", "access", "hex"))
        assert [s for s in rows[i].spans.split(",") if s and not s.startswith("net")] == spans


def test_network_finds_keys_and_leaves_words(spark):
    rng = random.Random(21)
    key = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(32))
    long_words = ["".join(corpora.word(rng) for _ in range(5)) for _ in range(600)]
    texts = [corpora.prose(rng, 8) + " " + w + " " + corpora.prose(rng, 8) for w in long_words]
    texts += ["password=" + "%016x" % rng.getrandbits(64) + " " + corpora.prose(rng, 5) for _ in range(80)]
    hidden = len(texts)
    texts.append(corpora.prose(rng, 6) + " " + key + " " + corpora.prose(rng, 6))
    rows = {r.doc_id: r for r in secret_scan.summary(secret_scan.scan(corpora.frame(spark, texts))).collect()}
    assert rows[hidden].n_net == 1
    assert sum(rows[i].n_net for i in range(600)) <= 12  # held to the recall first


def test_secret_scan_of_nothing(spark):
    assert secret_scan.scan(corpora.frame(spark, [])).collect() == []
    rows = secret_scan.summary(secret_scan.scan(corpora.frame(spark, [None, ""], ids=[None, 1]))).collect()
    assert [(r.spans, r.base_sha256) for r in rows] == [("", corpora.sha(""))] * 2


def words_in_text(rng, count):
    words = sorted({"".join(corpora.word(rng) for _ in range(6)) for _ in range(count)})
    return [secret_scan.codes("said " + w + " then", 5, 5 + len(w)) for w in words if len(w) >= secret_scan.LEAST]


def test_threshold_keeps_the_recall_asked():
    rng = random.Random(22)
    network = secret_scan.trained([], words_in_text(rng, 900))
    made = np.random.default_rng(99)
    keys = [secret_scan.random_key(made) for _ in range(1500)]
    unseen = np.frombuffer(b"".join(secret_scan.codes("said " + k + " then", 5, 5 + len(k)) for k in keys), np.uint8)
    found = network.probabilities(unseen.reshape(-1, secret_scan.LENGTH)) >= network.threshold
    assert found.mean() >= secret_scan.RECALL - 0.03  # of keys that neither training nor calibration saw
    others = np.frombuffer(b"".join(words_in_text(rng, 600)), np.uint8).reshape(-1, secret_scan.LENGTH)
    assert (network.probabilities(others) >= network.threshold).mean() <= 0.05


def test_candidates_are_read_whole_and_where_a_fixed_span_touches_them(spark):
    rng = random.Random(27)
    key = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(28))
    path = "/".join(["services", "registered", "customers", "documents", "reliability", "archives"])
    assert len(path) >= 60
    plain = ["".join(corpora.word(rng) for _ in range(6)) for _ in range(500)]
    plain += ["/".join(corpora.word(rng) + corpora.word(rng) for _ in range(9)) for _ in range(200)]
    texts = [f"{corpora.prose(rng, 5)} {w} {corpora.prose(rng, 5)}" for w in plain]
    hidden = [f"see {path}/{key} now", f"see {key}{'0123456789abcdef' * 2}{key} now", f"see {path}{'/' + path} now", "see " + path * 300 + key + path + " now"]
    rows = {r.doc_id: r for r in secret_scan.scan(corpora.frame(spark, texts + hidden)).collect()}
    found = [[(s.kind, s.start, s.end) for s in rows[len(texts) + i].spans] for i in range(len(hidden))]
    assert found[0] == [("net", 4, 4 + len(path) + 1 + len(key))]
    assert ("net", 4, 4 + 2 * len(key) + 32) in found[1] and any(kind == "hex" for kind, *_ in found[1])
    assert found[2] == []
    assert [kind for kind, *_ in found[3]] == ["net"]


def test_views_show_every_character():
    for length in (16, 39, 40, 41, 60, 61, 79, 80, 81, 1000):
        text = "x" * 30 + "".join(chr(33 + i % 90) for i in range(length)) + "y" * 30
        seen = secret_scan.views(text, 30, 30 + length)
        inside = [bytes(c + 31 for c in view[secret_scan.BEFORE:secret_scan.BEFORE + secret_scan.INSIDE] if c).decode() for view in seen]
        assert text[30:30 + length].startswith(inside[0]) and text[30:30 + length].endswith(inside[-1])
        assert len(inside) == max(1, -(-(length - 40) // 20) + 1) and all(len(part) == min(40, length) for part in inside)


def test_licenses_are_found_whole_and_nearly_whole(spark):
    rng = random.Random(23)
    names = sorted(license_scan.TEMPLATES)
    texts, wanted = corpora.odd_texts(rng), []
    wanted += [set() for _ in texts]
    for i in range(300):
        parts, found = [corpora.prose(rng, rng.randint(0, 300))], set()
        for name in rng.sample(names, rng.randint(0, 2)):
            parts += [license_scan.TEMPLATES[name].upper() if i % 3 == 0 else license_scan.TEMPLATES[name], corpora.prose(rng, rng.randint(0, 80))]
            found.add(name)
        texts.append(" ".join(parts))
        wanted.append(found)
    for name, share in (("MIT-text", 0.1), ("BSD-text", 0.5)):  # the end cut off
        words = license_scan.TEMPLATES[name].split()
        texts.append(corpora.prose(rng, 50) + " " + " ".join(words[:round(len(words) * (1 - share))]) + " " + corpora.prose(rng, 50))
        wanted.append({name} if share < 0.2 else set())
    rows = {r.doc_id: r for r in license_scan.scan(corpora.frame(spark, texts)).collect()}
    assert [{m.license for m in rows[i].matches} for i in range(len(texts))] == wanted
    for i, text in enumerate(texts):
        for match in rows[i].matches:
            piece = corpora.WORD.findall(text)[match.start:match.stop]
            assert match.containment >= 0.8 and len(piece) >= 5
            if match.containment == 1 and match.license != "MIT-text":
                assert " ".join(piece).lower() == " ".join(corpora.WORD.findall(license_scan.TEMPLATES[match.license])).lower()


def test_licenses_in_wordings_that_are_not_templates(spark):
    rng = random.Random(26)
    gpl = ("This program is free software; you can redistribute it and/or modify it\nunder the terms of the GNU General Public License "
           "as published by the\n  Free Software Foundation; either version 2 of the License, or any later version.")
    whole = license_scan.TEMPLATES["GPL-3.0-text"].split()
    mit = license_scan.TEMPLATES["MIT-text"].replace("Software", "Work", 2)
    cases = {
        "Distributed under the MIT License": {"MIT-distributed"},
        "see the GNU General Public License, version 2 for more": {"GPL-2.0"},
        "This library is available under the GNU Lesser General Public License.": {"LGPL"},
        gpl: {"GPL-header"}, gpl.replace("General", "Affero General"): {"AGPL-header"},
        "Copyright 2020 Somebody\n" + mit: {"MIT-text"}, " ".join(whole[:2600] + whole[2900:]): {"GPL-3.0-text"},
        "This book is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": {"CC-BY-SA-4.0-notice"},
    }
    texts = [f"{corpora.prose(rng, 40)} {text} {corpora.prose(rng, 30)}" for text in cases]
    rows = {r.doc_id: r for r in license_scan.scan(corpora.frame(spark, texts)).collect()}
    assert [{m.license for m in rows[i].matches} for i in range(len(texts))] == list(cases.values())


def test_license_scan_of_nothing(spark):
    assert license_scan.scan(corpora.frame(spark, [])).collect() == []


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "l", 2) for r in rows], "page_id long, url string, html string, host string, mark long, lines string, pages long")


def test_lines_above_the_ratio_are_dropped_on_their_host_only(spark):
    menu, body = "<nav><ul><li>Home</li><li>News</li></ul></nav>", "<p>text {}</p><p>Home</p>"
    rows = [(i, f"https://User@A.example:80/{i}", "<!-- x\n --><script>var a='<p>'</script>" + menu + body.format(i)) for i in range(10)]
    rows += [(100 + i, "http://b.example/x", f"<p>Home</p>{'<div>rare</div>' if i < 3 else ''}<b>in</b>line {i}") for i in range(10)]
    rows += [(200, "http://c.example", "<p>Home</p>"), (201, None, None), (202, "not an address", "alone<br>\nHome"), (None, "http://a.example", menu)]
    found = {r.page_id: r for r in line_dedup.drop_boilerplate(pages(spark, rows)).collect()}
    assert [found[i].kept_text for i in range(10)] == [f"text {i}" for i in range(10)]
    assert (found[0].host, found[0].n_lines, found[0].n_dropped) == ("a.example", 4, 3)
    assert found[100].kept_text == "rare\ninline 0" and found[109].kept_text == "inline 9"
    assert found[200].kept_text == "Home"  # one page is no pattern
    assert (found[201].n_lines, found[202].kept_text, found[None].kept_text) == (0, "alone\nHome", "")


def test_repeated_pages_and_empty_table(spark):
    rows = [(1, "http://a.example", "<p>one</p><p>two</p>")] * 3 + [(1, "http://a.example", "three")]
    found = sorted((r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.drop_boilerplate(pages(spark, rows)).collect())
    assert found == [(1, 0, "three"), (2, 2, ""), (2, 2, ""), (2, 2, "")]
    assert line_dedup.drop_boilerplate(pages(spark, [])).collect() == []


def test_the_secret_network_learns_from_every_window(spark, monkeypatch):
    """No window is left out, however many there are, and slices together learn what one would."""
    rng = random.Random(31)
    texts = ["said " + "".join(corpora.word(rng) for _ in range(6)) + " then" for _ in range(500)]
    found = corpora.frame(spark, texts).mapInArrow(secret_scan._found, secret_scan.FOUND).localCheckpoint()
    windows = {bytes(c) for r in found.collect() for c in r.around}
    examples = secret_scan._examples(found).collect()
    assert {bytes(r.code) for r in examples if not r.label} == windows and len(examples) == 2 * len(windows)
    monkeypatch.setattr(secret_scan, "SLICE", 200)
    monkeypatch.setattr(secret_scan, "LEAST_EPOCHS", 8)
    network = secret_scan.network_of(found)
    held = [(bytes(r.code), r.label) for r in examples if r.back]
    chances = network.probabilities(np.frombuffer(b"".join(c for c, _ in held), np.uint8).reshape(-1, secret_scan.LENGTH))
    made = np.sort(chances[[label > 0 for _, label in held]])
    assert network.threshold == pytest.approx(made[int((1 - secret_scan.RECALL) * len(made))], rel=1e-9)
    assert (chances[[not label for _, label in held]] >= network.threshold).mean() <= 0.1
