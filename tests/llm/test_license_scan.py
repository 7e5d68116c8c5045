import random
import time

import pytest
import regex

from ordermill.llm.license_scan import NOTICES, PHRASES, Notice, license_digest, normal_words, scan_licenses
from tests.llm.conftest import LONG, alnum_words


def mutated(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        rng.choice([lambda: text.pop(at), lambda: text.insert(at, "q"), lambda: text.__setitem__(at, "q")])()
    return "".join(text)


def test_words_are_those_of_the_pattern():
    for text in (None, "", "A b-C é1", LONG[:500], "İstanbul ÀB\x00c"):
        assert [w.decode() for w in normal_words(text)] == alnum_words(text)


def test_seeds_lose_no_occurrence():
    """Any text within the bound of a notice is found, as by a search of the whole text."""
    rng = random.Random(4)
    for text, label in NOTICES.items():
        notice = Notice(text, label, 0.1)
        whole = regex.compile(b"(?:" + regex.escape(notice.text) + b"){e<=%d}" % notice.edits, regex.BESTMATCH)
        for _ in range(25):
            said = f" some words {mutated(rng, text, rng.randint(0, notice.edits + 2))} and more ".encode()
            assert bool(list(notice.places(said))) == bool(whole.search(said))


def test_spans_and_base_places(spark, odd_docs, no_docs):
    texts = [
        "Released under the MIT License. under the mit license!", "Relased under the MIT Licence",
        "apache license, version 2 cc by nc", "x released under the mit license y",
        "licensed under the gnu general public license version 3", None, "", "nothing here",
    ]
    docs = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(texts)], "doc_id long, text string, score double")
    scanned = scan_licenses(docs)
    found = {r.doc_id: r for r in license_digest(scanned).collect()}
    base = {k: sorted((at, label) for p, label in PHRASES.items() for at in range(len(alnum_words(t)))
                      if alnum_words(t)[at : at + len(p.split())] == p.split()) for k, t in enumerate(texts)}
    for k, places in base.items():
        r, starts = found[k], [at for at, _ in places]
        assert (r.n_words, r.n_base) == (len(alnum_words(texts[k])), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1
    assert found[1].labels == "mit" and found[1].n_base == 0 and 0.9 < found[1].score < 1
    assert found[4].labels == "gpl-3" and found[7].labels == "" and found[7].score == 0
    span = {r.doc_id: r.spans for r in scanned.collect()}[3][0]
    assert (span.start, span.stop, span.edits, span.text) == (1, 6, 0, "released under the mit license")
    assert license_digest(scan_licenses(odd_docs)).count() == 9
    assert scan_licenses(no_docs).count() == 0


def test_a_weaker_notice_before_a_better_one_is_found():
    notice = Notice("released under the mit license", "mit", 0.1)
    said = b" code releesed undor the mit license and released under the mit license here "
    assert [(p.start, p.stop, p.edits) for p in notice.places(said)] == [(1, 6, 2), (7, 12, 0)]
    weak = b" releesed undor the mit license relesed under the mit license" * 3
    assert [p.edits for p in notice.places(weak + b" released under the mit license ")] == [2, 1] * 3 + [0]


def slowly(notice, text):
    """The best match of the whole text, then those before and behind it."""
    found, pending = [], [(0, len(text))]
    while pending:
        low, high = pending.pop()
        if high - low < len(notice.text) - notice.edits:
            continue
        match = notice.pattern.search(text, low, high)
        if match:
            start, stop = match.span()
            said = text[start:stop].strip(b" ")
            start += text[start:stop].find(said)
            found.append((text.count(b" ", 0, start) - 1, text.count(b" ", 0, start + len(said)), sum(match.fuzzy_counts)))
            pending += [(low, match.start() + (text[match.start()] == 32)), (stop - (text[stop - 1] == 32), high)]
    return sorted(found)


def test_repeated_notices_give_the_spans_of_a_search_of_the_whole():
    rng = random.Random(8)
    for text, label in list(NOTICES.items())[:4]:
        notice = Notice(text, label, 0.1)
        for between in ("", " and", " so it is said of many other things here"):
            said = "".join(f" {mutated(rng, text, rng.choice([0, 0, 1, 2]))}{between}" for _ in range(12)).encode() + b" "
            assert [(p.start, p.stop, p.edits) for p in notice.places(said)] == slowly(notice, said)


@pytest.mark.parametrize("edits", [0, 2])
def test_a_megabyte_of_notices_takes_seconds(edits):
    rng = random.Random(2)
    notice = Notice("released under the mit license", "mit", 0.1)
    some = b"".join(f" {mutated(rng, 'released under the mit license', edits)}".encode() for _ in range(1_000))
    text = some * 33 + b" "
    start = time.process_time()
    found = list(notice.places(text))
    assert time.process_time() - start < 10 and len(found) >= 32_000
    assert found[-1].stop <= text.count(b" ")
