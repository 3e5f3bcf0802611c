import re

import cases

from ldspark.llm import license_scan as s

MIT = next(t.text for t in s.TEMPLATES if t.text.startswith("Permission"))


def plain(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = sorted(
        (i, label)
        for phrase, label in s.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({p[1] for p in places}))


def texts():
    lorem = "the of and in is a to software " * 30
    return [
        "Released under the MIT License.\n" + lorem + " MIT-License mit license mit license",
        lorem + "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0. " + lorem,
        "licensed under the apache license, version 9",
        "Licensed under CC BY-NC 4.0.",
        lorem + MIT + " " + lorem,
        lorem + MIT.replace("obtaining", "getting").replace("merge, ", "") + " " + lorem,
        lorem + MIT.replace("hereby", "not") + " " + lorem,
        "license license",
        "mit İ license Mit license",
    ]


def test_base_equals_brute_force(spark):
    rows = cases.documents() + [(1000 + i, t, None, None, 0) for i, t in enumerate(texts())]
    found = s.scan_licenses(cases.clashing(spark, rows)).collect()
    told = sorted(str((r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in found)
    assert told == sorted(str((r[0], *plain(r[1]))) for r in rows)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found)


def test_templates_are_found_by_position(spark):
    rows = [(1000 + i, t, None, None, 0) for i, t in enumerate(texts())] + cases.documents(2)
    found = {r.id - 1000: r for r in s.scan_licenses(cases.frame(spark, rows)).where("id >= 1000").collect()}
    assert found[0].labels == "mit" and found[0].score == 1.0
    assert found[1].labels == "gpl,gpl-3.0"
    assert found[2].labels == "apache,apache-2.0"
    assert found[3].labels == "apache" and found[3].score == s.PHRASE_SCORE
    assert found[4].labels == "cc-by-nc-4.0" and found[4].n_base == 0
    assert found[5].labels == "mit" and found[5].score == 1.0
    assert found[6].labels == "mit" and s.COVERAGE <= found[6].score < 1
    assert found[7].labels == "", "a mandatory phrase is missing"
    assert found[8].labels == ""


def test_frequencies_count_all_documents(spark):
    rows = cases.documents() + [(1, "license License", None, None, 0), (2, "the license", None, None, 0)]
    counts, n = s.document_frequencies(cases.frame(spark, rows))
    assert n == len(rows) and counts[b"license"] == 2


def test_empty_table(spark):
    assert s.scan_licenses(cases.frame(spark, [])).count() == 0


def test_every_notice_of_a_long_text_is_found():
    stray = "any copies the following conditions either free or redistribution permitted express distributed "
    text = stray * 40 + (" " + stray * 5).join(t.text for t in s.TEMPLATES) + " " + stray * 40
    vocabulary = s.Index(s.TEMPLATES).vocabulary
    for frequencies in ({}, {w: len(w) for w in vocabulary}, {w: 20 - len(w) for w in vocabulary}):
        index = s.Index(s.TEMPLATES, frequencies, 1000)
        found = index.matches(s.words_of(text))
        assert sorted(found) == list(range(len(s.TEMPLATES)))
        assert all(covered == 1.0 for covered, _ in found.values())
