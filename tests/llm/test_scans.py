"""Secret and licence scans against brute force."""

import base64
import json
import random
import re
import string
import time

import pytest
from hypothesis import given, settings, strategies as st

from postloom.llm import licences, secrets

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


PIECES = ["token", "TOKEN", "password", "secret", "api_key", "apikey", "passwd", "AKIA", "akia", "=", ": ", '"', "'", " ", "0123456789abcdef", "deadbeef", "ABCDEFGHIJKLMNOP", "é", "ſecret", "toKen", "\n", "x"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_secrets_are_those_of_the_plain_patterns(text):
    assert [s for s in secrets.find_secrets(text) if s[0] in secrets.BASE_KINDS] == plain(text)


OWN = ["eyJ", "eyJhbGciOiJub25lIn0", ".", "-", "_", "x", " ", "ghp_", "npm_", "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5", "123456", "-----BEGIN ", "PRIVATE KEY", "-----", "RSA ", "QUJD", "\n", "-----END "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(OWN), max_size=30).map("".join))
def test_own_kinds_are_those_of_the_plain_patterns(text):
    expected = sorted((kind, m.start(), m.end()) for kind, _, pattern, valid in secrets.KEYWORD_KINDS[2:] for m in pattern.finditer(text) if valid(m))
    assert sorted(s for s in secrets.find_secrets(text) if s[0] not in secrets.BASE_KINDS) == expected


@pytest.mark.parametrize("piece", ["eyJ", "eyJ.", "eyJa.eyJb ", "token", "token=", "api_key ", "AKIA", "akia", "ghp_", "-----BEGIN ", "-----BEGIN PRIVATE KEY-----", "PRIVATE KEY ", "f", "password" + " " * 50])
def test_long_runs_are_scanned_once(piece):
    began = time.perf_counter()
    secrets.find_secrets(piece * (5_000_000 // len(piece)))
    assert time.perf_counter() - began < 30


def test_checksums_decide():
    body = "".join(random.Random(1).choices(string.ascii_letters + string.digits, k=30))
    good = f"ghp_{body}{secrets.forge_checksum(body)}"
    wrong = good[:-1] + ("a" if good[-1] != "a" else "b")
    assert ("forge", 2, 2 + len(good)) in secrets.find_secrets("x " + good)
    assert not any(kind == "forge" for kind, _, _ in secrets.find_secrets("x " + wrong))
    part = base64.urlsafe_b64encode(json.dumps({"alg": "none"}).encode()).decode().rstrip("=")
    assert [s[0] for s in secrets.find_secrets(f"{part}.{part}.sig_")] == ["web_token"]
    assert secrets.find_secrets("eyJxxx.eyJyyy.zzz") == []
    block = "-----BEGIN RSA PRIVATE KEY-----\nQUJD\n-----END RSA PRIVATE KEY-----"
    assert ("key_block", 0, len(block)) in secrets.find_secrets(block)


def test_secret_rows(spark):
    rows = [(1, "token=abcdefghijkl", 1), (1, "token=abcdefghijkl", 1), (None, "x", 2), (2, None, 3), (3, "", 4), (4, "a" * 200_000, 5)]
    found = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, secrets int")).collect()
    assert sorted((r["doc_id"] or 0, len(r["secrets"])) for r in found) == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 0), (4, 1)]
    assert secrets.scan_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


WORDS = ["mit", "License", "apache", "general", "public", "license", "the", "gnu", "under", "x1", "é"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=40), st.sampled_from([" ", "\n", ", "]))
def test_base_phrases_are_found_everywhere(words, gap):
    lowered = [w.lower() for w in words]
    expected = [(label, i) for i in range(len(words)) for phrase, label in licences.PHRASES if lowered[i:i + len(phrase.split())] == phrase.split()]
    n, hits, _ = licences.default_scanner().scan(gap.join(words))
    assert n == len(words) and sorted(hits) == sorted(expected)


def test_matching_statistics():
    automaton = licences.SuffixAutomaton.of([list("abcbc"), list("bcd"), list("abcd")])
    sequences = ["abcbc", "bcd", "abcd"]
    for text in {s[i:j] for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}:
        state = automaton.walk(text)
        ends = {(n, i + len(text) - 1) for n, s in enumerate(sequences) for i in range(len(s)) if s.startswith(text, i)}
        assert set(automaton.places[state]) == ends


def test_spans_chain_over_gaps():
    text = licences.TEMPLATES[1][1]
    words = text.split()
    cut = " ".join(words[:20] + ["other", "words"] + words[22:])
    _, _, spans = licences.default_scanner().scan("before it " + cut + " after")
    label, start, end, covered, cover = max(spans, key=lambda s: s[3])
    assert (label, start, end, covered) == ("mit", 2, 2 + len(words), len(words) - 2) and cover > 0.9
    twice = licences.default_scanner().scan("Licensed under CC BY-NC 4.0. " * 3)[2]
    assert [s[0] for s in twice] == ["cc-by-nc"] * 3


def test_blocks_do_not_cut_words():
    text = "mit license " * 50
    assert [w for part in licences.words_of(text, 7) for w in part] == text.split()


def test_licence_rows(spark):
    rows = [(1, "MIT License", 1), (1, "MIT License", 1), (None, "x", 2), (2, None, 3), (3, "", 4), (4, "license " * 50_000, 5)]
    found = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], len(r["phrases"])) for r in found) == [(0, 1, 0), (1, 2, 1), (1, 2, 1), (2, 0, 0), (3, 0, 0), (4, 50_000, 0)]
    assert licences.scan_licences(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def right_maximal(templates, words, least):
    """Per template: ``(text end, template end, length)`` of all matches that go on neither to the left nor to the right."""
    out = set()
    for number, template in enumerate(templates):
        for i in range(len(words)):
            for j in range(len(template)):
                if words[i] == template[j] and not (i and j and words[i - 1] == template[j - 1]):
                    n = 0
                    while i + n < len(words) and j + n < len(template) and words[i + n] == template[j + n]:
                        n += 1
                    if n >= least:
                        out.add((number, i + n, j + n, n))
    return out


TOKENS = st.lists(st.sampled_from("abc"), min_size=1, max_size=9)


@settings(max_examples=300, deadline=None)
@given(st.lists(TOKENS, min_size=1, max_size=5), st.lists(st.sampled_from("abcd"), max_size=40))
def test_matches_are_those_of_brute_force(templates, words):
    scanner = licences.LicenceScanner([(str(i), " ".join(t)) for i, t in enumerate(templates)], [("a b", "x")], least_match=2)
    anchors = []
    scanner._chains = lambda number, found: anchors.extend((number, *a) for a in found) or []
    scanner.scan(" ".join(words))
    assert len(anchors) == len(set(anchors)) and set(anchors) == right_maximal(templates, words, 2)


def test_a_template_that_begins_another_keeps_its_span():
    start = "Licensed under the Apache License, Version 2.0. "
    for follower in ("The rest is ours.", "Nothing else.", "the license", ""):
        spans = licences.default_scanner().scan("x " + start + follower)[2]
        assert ("apache", 1, 9, 8, 1.0) in spans


def test_templates_of_the_caller(spark):
    rows = spark.createDataFrame([(1, "all rights are reserved by us"), (2, "Licensed under CC BY 4.0")], "doc_id long, text string")
    found = licences.scan_licences(rows, templates=[("ours", "all rights are reserved")], phrases=[("by us", "us")]).orderBy("doc_id").collect()
    assert [[(s["label"], s["start"], s["end"]) for s in r["spans"]] for r in found] == [[("ours", 0, 4)], []]
    assert [[(p["label"], p["start"]) for p in r["phrases"]] for r in found] == [[("us", 4)], []]
