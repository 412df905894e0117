"""Licences in texts by a generalised suffix automaton.

The automaton holds every run of words of every template. A text streams through it and gives
its matching statistics: at each word, the longest run ending there that some template holds.
Where a run ends that is long enough, it becomes an anchor; anchors that follow each other in
the text and in a template are chained into a span, and a template is found where its words
are covered. Short phrases are read off the automaton's states as the text passes.

Cases: a null or empty text has no words and no labels. Null ids and repeated rows stay, one
result per input row; an empty table gives an empty result; other columns are ignored.
"""

import bisect
from functools import lru_cache

from pyspark.sql import DataFrame

from pagespine.llm.license_texts import PHRASES, TEMPLATES
from pagespine.llm.texts import over_texts

#: Words of a run that may become an anchor; words between two anchors of a chain.
LEAST_RUN, MOST_GAP = 4, 12
#: Share of its words that must be covered: short templates (up to SHORT words), long ones.
SHORT, SHORT_SHARE, LONG_SHARE = 15, 1.0, 0.6

FOUND = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
)

# Letters in lower case; what is neither digit, letter nor beyond ASCII separates words.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str) -> list:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8."""
    return text.encode().translate(_WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences; state 0 is the empty run."""

    def __init__(self, sequences):
        self.next, self.link, self.length = [{}], [-1], [0]
        for words in sequences:
            state = 0
            for word in words:
                state = self._extend(state, word)

    def _state(self, length, transitions, link):
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state, word, target):
        """The state of runs of length up to ``state``'s plus one that ``target`` held until now."""
        clone = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = clone
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last, word):
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            target = self.next[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, word, target)
        return new

    def walk(self, words):
        """The state after each word of one of the sequences."""
        state = 0
        for word in words:
            state = self.next[state][word]
            yield state


@lru_cache(maxsize=1)
def _machine():
    """The automaton; per state, where templates hold it (template to last word) and the phrases that end there."""
    phrases = [words_of(text) for text, _ in PHRASES]
    templates = [words_of(text) for _, text in TEMPLATES]
    machine = Automaton([*phrases, *templates])
    places = [{} for _ in machine.next]
    for number, words in enumerate(templates):
        for end, state in enumerate(machine.walk(words)):
            while state > 0 and number not in places[state]:
                places[state][number] = end
                state = machine.link[state]
    own = [[] for _ in machine.next]
    for number, words in enumerate(phrases):
        *_, state = machine.walk(words)
        own[state].append((number, len(words)))
    ends = [()] * len(machine.next)
    for state in sorted(range(1, len(ends)), key=machine.length.__getitem__):
        ends[state] = (*own[state], *ends[machine.link[state]])
    return machine, places, ends, [len(words) for words in templates]


def _stream(words):
    """Anchors (first word, last word, state) and phrase places (phrase, first word)."""
    machine, _, ends, _ = _machine()
    following, link, length = machine.next, machine.link, machine.length
    anchors, phrases, state, run = [], [], 0, 0
    for i, word in enumerate(words):
        target = following[state].get(word)
        if target is None:
            if not state:
                continue
            if run >= LEAST_RUN:
                anchors.append((i - run, i - 1, state))
            while state > 0 and word not in following[state]:
                state = link[state]
            run = length[state]
            target = following[state].get(word)
            if target is None:
                run = 0
                continue
        state = target
        run += 1
        for number, size in ends[state]:
            if size <= run:
                phrases.append((number, i - size + 1))
    if run >= LEAST_RUN:
        anchors.append((len(words) - run, len(words) - 1, state))
    return anchors, phrases


def _chains(anchors):
    """(covered share, covered words, template, first word, last word) of each template's chains."""
    _, places, _, sizes = _machine()
    open_chains, chains = {}, []
    for first, last, state in anchors:
        for number, end in places[state].items():
            chain = open_chains.get(number)
            if chain and end > chain[3] and first - chain[1] <= MOST_GAP + 1:
                chain[2] += min(last - max(first, chain[1] + 1) + 1, end - chain[3])
                chain[1], chain[3] = last, end
            else:
                open_chains[number] = chain = [first, last, last - first + 1, end, number]
                chains.append(chain)
    return [(min(1.0, c[2] / sizes[c[4]]), c[2], c[4], c[0], c[1]) for c in chains]


def covered_spans(anchors):
    """Template spans with enough of their template covered; of those that overlap, the one that covers most."""
    _, _, _, sizes = _machine()
    good = [c for c in _chains(anchors) if c[0] >= (SHORT_SHARE if sizes[c[2]] <= SHORT else LONG_SHARE)]
    taken, chosen = [], []
    for share, covered, number, first, last in sorted(good, key=lambda c: (-c[1], -c[0], c[2], c[3])):
        # Spans taken so far are disjoint, so only the neighbours can overlap.
        at = bisect.bisect(taken, (first, last))
        if (at == 0 or taken[at - 1][1] < first) and (at == len(taken) or last < taken[at][0]):
            taken.insert(at, (first, last))
            chosen.append((first, last, TEMPLATES[number][0], share))
    return sorted(chosen)


def _scan(texts: list) -> list:
    rows = []
    for text in texts:
        words = words_of(text or "")
        anchors, phrases = _stream(words)
        spans = covered_spans(anchors) if anchors else []
        base = sorted({PHRASES[number][1] for number, _ in phrases})
        starts = [start for _, start in phrases]
        labels = sorted({*base, *(label for _, _, label, _ in spans)})
        score = max([1.0] * bool(base) + [share for *_, share in spans], default=0.0)
        rows.append((
            len(words), len(phrases), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels), score,
            ",".join(f"{label}:{first}:{last}" for first, last, label, _ in spans),
        ))
    return rows


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, phrase places, labels, the best covered share, and template spans (``label:first word:last word``)."""
    return docs.select("doc_id", over_texts(_scan, FOUND)("text").alias("r")).select("doc_id", "r.*")
