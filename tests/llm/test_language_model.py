"""Op 5: what one row or one task of the language model holds."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from beaconlake.llm import grams, pitman_yor

TEXTS = [f"one two three four w{i % 7} one two" for i in range(60)] + [None, "", "only here"]


def train():
    return F.col("doc_id") % 10 != 0


def rows(copies: int) -> list[tuple]:
    return [(c * len(TEXTS) + i, t) for c in range(copies) for i, t in enumerate(TEXTS)]


def test_stored_rows_do_not_grow_with_repeated_texts(docs, monkeypatch):
    kept = pitman_yor.staged

    def sizes(copies: int) -> tuple[int, int]:
        found = []

        def spy(frame, label, *more):
            out = kept(frame, label, *more)
            if label == "fragments":
                binary = [c for c, kind in out.dtypes if kind == "binary"]
                found.append(out.agg(F.max(sum((F.length(c) for c in binary), F.lit(0))), F.count(F.lit(1))).first())
            return out

        monkeypatch.setattr(pitman_yor, "staged", spy)
        assert pitman_yor.score(docs(*rows(copies)), train()).count() == copies * len(TEXTS)
        return tuple(found[0])

    assert sizes(1) == sizes(20)


def test_places_of_a_frequent_pair_are_dealt_to_slices(docs, monkeypatch):
    given = docs(*rows(8)).repartition(6)
    whole = {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in pitman_yor.score(given, train()).collect()}
    scores, copies = pitman_yor._text_scores, []

    def spy(placed, *more):
        counts = placed.where(F.col("block") == pitman_yor.COUNTS).groupBy("fragment").count()
        copies.append(counts.agg(F.max("count")).first()[0])
        return scores(placed, *more)

    monkeypatch.setattr(pitman_yor, "_text_scores", spy)
    monkeypatch.setattr(pitman_yor, "SLICE", 200)
    dealt = {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in pitman_yor.score(given, train()).collect()}
    assert copies[0] > 1 and dealt.keys() == whole.keys() and len(whole) == 8 * len(TEXTS)
    assert all(dealt[k] == pytest.approx(whole[k]) for k in whole)


RARE = [f"a{i % 9} b{i % 4} r{i} s{i // 2} r{i} s{i // 2} a{i % 9} t{i // 3}xyz b{i % 4} u{i}xyz" for i in range(40)] + [None, "", "new words new words"]


def fields(found):
    return {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score, r.perplexity) for r in found.collect()}


def test_rare_words_are_scored_as_frequent_ones(docs, monkeypatch):
    """However many words are in the list of frequent ones, each has its own dish and restaurant."""
    given = docs(*enumerate(RARE)).repartition(5)
    whole = fields(pitman_yor.score(given, train()))
    assert len(whole) == len(RARE)
    for words in (0, 9, 40):
        monkeypatch.setattr(pitman_yor, "WORDS", words)
        found = fields(pitman_yor.score(given, train()))
        assert found.keys() == whole.keys() and all(found[k] == pytest.approx(whole[k]) for k in whole)


def test_scores_in_plain_python(docs, monkeypatch):
    """All sweeps, a word and a pair at a time; and probabilities of each context that sum to one."""
    lists = {i: [*(t or "").split(), None] for i, t in enumerate(RARE)}
    pairs = {i: list(zip(["<", *words], words)) for i, words in lists.items()}
    counts = Counter(p for i, some in pairs.items() if i % 10 for p in some)
    dishes, customers = {w for _, w in counts}, Counter()
    for (v, _), n in counts.items():
        customers[v] += n
    ones, twos = (sum(n == k for n in counts.values()) for k in (1, 2))
    d = ones / (ones + 2 * twos)
    uniform = 1 / (len(dishes) + 1)

    def name(word):
        if word is None or word == "<":
            return pitman_yor._END_NAME if word is None else pitman_yor._START_NAME
        return next(grams.sliced(pa.array([word]), grams.SPACED))[1].hash[0]

    def tables(n, new, context, dish, sweep):
        key = pitman_yor._pair(np.array([context], np.uint64), np.array([dish], np.uint64))
        return pitman_yor.seat(np.array([n]), np.array([new]), d, pitman_yor._chance(key, sweep))[0]

    seated, states = dict.fromkeys(counts, 1), []
    for sweep in range(pitman_yor.SWEEPS + 1):
        if sweep:
            of_context, share = states[-1][2], states[-1][3]
            seated = {(v, w): tables(n, (1 + d * of_context[v]) * share(w), name(v), name(w), sweep) for (v, w), n in counts.items()}
        eating, of_context = Counter(), Counter()
        for (v, w), t in seated.items():
            eating[w] += int(t)
            of_context[v] += t
        at_parent = dict.fromkeys(dishes, 1)
        for turn in range(1, pitman_yor.SWEEPS + 1):
            new = (1 + d * sum(at_parent.values())) * uniform
            at_parent = {w: tables(eating[w], new, 0, name(w), sweep | turn << 8) for w in dishes}
        total, opened = sum(eating.values()), sum(at_parent.values())

        def share(w, eating=eating, at_parent=at_parent, total=total, opened=opened):
            return (eating[w] - d * at_parent.get(w, 0) + (1 + d * opened) * uniform) / (1 + total)

        states.append((sweep, seated, of_context, share))
    kept = states[-pitman_yor.KEPT :]

    def p(v, w):
        each = [(counts[v, w] - d * t.get((v, w), 0) + (1 + d * of[v]) * share(w)) / (1 + customers[v]) for _, t, of, share in kept]
        return sum(each) / len(each)

    assert all(sum(p(v, w) for w in [*dishes, "never seen"]) == pytest.approx(1) for v in [*customers, "never seen"])
    for words in (pitman_yor.WORDS, 7):
        monkeypatch.setattr(pitman_yor, "WORDS", words)
        found = fields(pitman_yor.score(docs(*enumerate(RARE)), train()))
        assert {i: r[3] for i, r in found.items()} == pytest.approx({i: sum(math.log10(p(*x)) for x in some) for i, some in pairs.items()})


def test_words_beyond_the_list_keep_their_pairs(docs):
    """70,000 words seen once: a pair that was learned is likelier than one of words as frequent that end alike."""
    learned = [(10 * i + 1, " ".join(f"w{i}x{j}" for j in range(1000))) for i in range(70)]
    learned += [(1001, "left-abc right-abc"), (1002, "other-abc")]
    held = [(1000, "left-abc right-abc"), (1010, "left-abc other-abc")]
    found = fields(pitman_yor.score(docs(*learned, *held), train()))
    assert found[1000][:2] == found[1010][:2] == (3, 3) and found[1000][2] == pytest.approx(found[1010][2])
    assert found[1000][3] > found[1010][3] + 0.3
