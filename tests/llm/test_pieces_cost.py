"""The encoder spares work without another result."""

import random
from dataclasses import replace

import pytest

from tillmart.llm import pieces

from tests.llm.cases import documents, prose


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def test_pieces_on_no_best_path_are_not_looked_for(vocabulary):
    marked = pieces.without_idle(vocabulary)
    assert len(marked.idle) > len(marked.plain) / 2
    every, fewer = pieces.Encoder(vocabulary), pieces.Encoder(marked)
    assert len(fewer.automaton) == len(every.automaton) - len(marked.idle)
    draw = random.Random(5)
    plain = [vocabulary.pieces[i] for i in sorted(vocabulary.plain)]
    texts = ["".join(draw.choice(plain) for _ in range(draw.randrange(1, 5))) for _ in range(3000)]
    texts += ["".join(draw.choice("abcé你\n\U0001f600▁ x") for _ in range(9)) for _ in range(3000)]
    assert all(fewer.path(t) == every.path(t) for t in texts)
    for row in documents():
        assert fewer.encode(row[1] or "").tolist() == every.encode(row[1] or "").tolist()


def test_scores_that_are_no_whole_numbers_mark_nothing(vocabulary):
    halves = replace(vocabulary, scores=tuple(s / 3 for s in vocabulary.scores))
    assert pieces.without_idle(halves) == halves


def test_a_segment_met_again_is_not_searched_again(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "KEEP", 40)
    encoder, plain = pieces.Encoder(vocabulary), pieces.Encoder(vocabulary)
    searched = []
    encoder.known.path = lambda s: searched.append(s) or encoder.path(s)
    for i in range(60):
        text = f"often met {prose(i, 12)}"
        assert encoder.encode(text).tobytes() == plain.path(pieces.MARK + text.replace(" ", pieces.MARK))
        assert len(encoder.known) <= 40 and len(encoder.known.older) <= 40
    assert searched.count(f"{pieces.MARK}often") == 1
