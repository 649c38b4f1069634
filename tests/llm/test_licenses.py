from __future__ import annotations

import random
import re

import pytest

from armlens.llm import licenses
from tests.llm.texts import awkward, frame, prose


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = []
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(parts)] == parts]
    return len(words), sorted(places)


def test_phrases(spark):
    rows = awkward(random.Random(1)) + [
        (200, "Released under the MIT\n License. mit-license, MITlicense mit license"),
        (201, "GNU GENERAL -- public license; cc by CC-BY-NC ccby cc  by"), (202, "Apache\x00License apache licensed"),
        (203, "École MIT LicenseÉ mit licenseé"), (204, "cc by cc by cc"), (205, "x " * 9_000 + "apache license"),
    ]
    found = licenses.find_notices(frame(spark, rows)).collect()
    want = sorted(((i, *plain(t)) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], [tuple(p) for p in r["places"]]) for r in found), key=repr) == want


def test_summary(spark):
    rows = [(1, "cc by, apache license, cc by"), (2, None), (3, "Mozila Public Licence")]
    out = {r["doc_id"]: r for r in licenses.summarised(licenses.find_notices(frame(spark, rows))).collect()}
    assert (out[1]["n_base"], out[1]["first_word"], out[1]["last_word"]) == (3, 0, 4)
    assert (out[1]["base_labels"], out[1]["labels"], out[1]["score"]) == ("apache,cc-by", "apache,cc-by", 1.0)
    assert (out[2]["n_words"], out[2]["first_word"], out[2]["labels"], out[2]["score"]) == (0, None, "", 0.0)
    assert (out[3]["n_base"], out[3]["labels"]) == (0, "mpl") and 0.8 < out[3]["score"] < 1


def test_notices_with_allowed_edits_are_found_where_they_stand():
    rng = random.Random(7)
    finder = licenses.Finder()
    for notice in licenses.NOTICES:
        for _ in range(25):
            text = list(notice.words)
            for _ in range(rng.randint(0, notice.edits)):
                at = rng.randrange(1, len(text) - 1)
                kind = rng.randrange(3)
                letter = rng.choice("abcdefghij")
                text[at:at + (kind < 2)] = [] if kind == 0 else [letter]
            if not counts("".join(text), notice):
                continue
            before, body = prose(rng, rng.randint(0, 30)) + ". ", "".join(text).replace(" ", rng.choice((" ", "\n", " - ")))
            whole = f"{before}{body}, {prose(rng, 5)}"
            _, matches = finder.search(whole.lower().encode())
            hit = [m for m in matches if m[4] == notice.words]
            assert hit, whole
            assert any(abs(m[0] - len(before)) <= notice.edits + 3 and m[2] <= notice.edits for m in hit), (whole, hit)


def distance(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def counts(found, notice):
    """Short words with one edit at most, and what has to be kept as it is."""
    parts, words = found.split(" "), notice.words.split()
    if notice.kept and not re.search(rf"\b{notice.kept}", found):
        return False
    return len(parts) != len(words) or all(
        distance(p, w) <= (1 if len(w) < licenses.SURE else notice.edits) for p, w in zip(parts, words))


def scanned(text, notice):
    """All runs between word boundaries, by their edits, without seeds."""
    joined = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))
    bounds = [m.start() for m in re.finditer(r"\b", joined)]
    size = len(notice.words)
    runs = {(i, j): d for i in bounds for j in bounds if i < j and abs(j - i - size) <= notice.edits
            and joined[i] != " " != joined[j - 1]
            and (d := distance(joined[i:j], notice.words)) <= notice.edits and counts(joined[i:j], notice)}
    taken = []
    for run in sorted(runs, key=lambda r: (runs[r], abs(r[1] - r[0] - size), r)):
        if all(run[1] <= a or run[0] >= b for a, b, _ in taken):
            taken.append((*run, runs[run]))
    return sorted(taken)


def test_an_edited_notice_before_a_better_copy_is_found():
    mozilla = [m for m in licenses.Finder().search(b"mozila public license or the mozilla public license")[1] if m[3] == "mpl"]
    assert [m[:3] for m in mozilla] == [(0, 21, 1), (29, 51, 0)]


def test_several_notices_of_a_text_are_those_of_a_plain_scan():
    rng = random.Random(12)
    finder = licenses.Finder()
    for _ in range(60):
        parts = []
        for notice in (rng.choice(licenses.NOTICES) for _ in range(rng.randint(2, 6))):
            text = list(notice.words)
            for _ in range(rng.randint(0, notice.edits + 1)):
                at = rng.randrange(len(text))
                text[at:at + rng.randint(0, 1)] = rng.choice(("", "x", "\u00e9", " "))
            parts += ["".join(text)] * rng.randint(1, 2) + rng.choice(([], ["or the"], [notice.words], ["in c by w1"]))
        whole = " ".join(" ".join(parts).split())
        _, matches = finder.search(whole.encode())
        want = [(a, b, d, n.label, n.words) for n in licenses.NOTICES for a, b, d in scanned(whole, n)]
        assert matches == sorted(want), whole


@pytest.mark.parametrize("text, labels", [
    ("Distributed under the GNU General Public Licence", "gpl"), ("see the Apache\nLicence 2.0", "apache"),
    ("under the MIT -- Licence", "mit"), ("GNU genral public license", "gpl"), ("MITlicense", "mit"), ("mit licens", "mit"),
    ("apachi licence", "apache"), ("CC-BY 4.0", "cc-by"), ("under cc-bye", ""), ("cd by", ""),
    ("(c) by John Smith", ""), ("Washington DC by train", ""), ("Raleigh, NC by car", ""), ("a PC by Dell", ""),
    ("CC my boss", ""), ("subject to it license", ""), ("omit license headers", ""), ("the cache license server", ""),
    ("under the MIT licens\u00e9", "mit"), ("a limit license", ""),
    ("made by the general public", ""), ("a license of the mint", ""), ("by and by", ""), ("under apachi licences", ""),
])
def test_short_phrases_are_found_with_edits(text, labels):
    assert ",".join(sorted({m[3] for m in licenses.Finder().search(text.lower().encode())[1]})) == labels


def test_seeds_are_pieces_of_the_whole_notice():
    assert all("".join(licenses.seeds(n)) == n.words for n in licenses.NOTICES)
    assert licenses.seeds(licenses.Notice("mit license", "mit", 1)) == ["mit li", "cense"]
    with pytest.raises(ValueError):
        licenses.seeds(licenses.Notice("mit", "mit", 1))


def test_seeds_are_never_short_words():
    for notice in licenses.NOTICES:
        assert len(licenses.seeds(notice)) == notice.edits + 1
    with pytest.raises(ValueError):
        licenses.seeds(licenses.Notice("of the use", "x", 1))


def test_empty_table(spark):
    assert licenses.summarised(licenses.find_notices(frame(spark, []))).collect() == []
