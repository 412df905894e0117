"""Licence scan: phrases against a plain search, automaton and chains against all runs."""

import random
import re

import pytest

from pagespine.llm import licenses
from pagespine.llm.license_texts import PHRASES, TEMPLATES


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.fixture(params=["odd_documents", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_phrases(docs):
    rows = sorted(licenses.scan(docs).collect(), key=lambda r: r.doc_id if r.doc_id is not None else -1)
    texts = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.collect())
    for (_, text), row in zip(texts, rows, strict=True):
        words = plain_words(text)
        places = [(i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(",")) and 0 <= row.score <= 1


def test_automaton_gives_matching_statistics():
    draw = random.Random(3)
    for _ in range(200):
        sequences = [[draw.choice("abc") for _ in range(draw.randint(1, 9))] for _ in range(draw.randint(1, 4))]
        runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        machine = licenses.Automaton(sequences)
        text, state, size = [draw.choice("abcd") for _ in range(30)], 0, 0
        for i, word in enumerate(text):
            while state > 0 and word not in machine.next[state]:
                state = machine.link[state]
                size = machine.length[state]
            state, size = (machine.next[state][word], size + 1) if word in machine.next[state] else (0, 0)
            assert size == max((n for n in range(i + 2) if tuple(text[i + 1 - n : i + 1]) in runs or n == 0))


def labels(text):
    return licenses._scan([text])[0][5]


def test_templates():
    for label, text in TEMPLATES:
        assert label in labels("Vorwort. " + text + " und mehr").split(",")
    assert labels("Released under the MIT License.") == "mit"
    assert labels("This work is licensed under the GNU General Public License, version 3.") == "gpl,gpl-3.0"
    assert labels("Licensed under CC BY-NC 4.0.") == "cc-by,cc-by-nc"


def test_damaged_and_absent_templates():
    words = dict(TEMPLATES)["isc"].split()
    words[6], words[20] = "anything", "something else"
    assert labels(" ".join(words)) == "isc"
    assert labels("to use, copy and sell the software in any form, subject to conditions") == ""
    assert labels("the license of the library under version 2") == ""


def test_many_licences_in_one_text():
    found = licenses._scan(["Released under the MIT License.\nword\n" * 20_000])[0]
    assert found[5] == "mit" and found[7].count("mit") == 20_000


def test_empty_table(no_documents):
    assert licenses.scan(no_documents).count() == 0
