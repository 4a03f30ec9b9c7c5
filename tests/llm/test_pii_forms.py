"""Personal data in written-out forms, and spans longer than what two windows share."""

import numpy as np
import pytest
from test_learned import carriers

from tidemark.llm import pii
from tidemark.llm.tagger import Tagger

WRITTEN_OUT = [
    "jane.doe [at] example [dot] com", "jane (at) example.com", "jane at example dot com", "jane.doe[at]example[dot]org",
    "JANE AT EXAMPLE DOT COM", "(017) 555-771", "(01) 555-7713", "5557-7713",
]


@pytest.mark.parametrize("form", WRITTEN_OUT)
def test_forms_without_a_plain_sign_are_read_and_plausible(form):
    assert pii.plausible(3 if form[0] in "(5" else 0, form)
    text = f"{'plain words go on ' * 30}{form} {'plain words go on ' * 30}"
    covered = {i for s in pii.window_starts(text, around=True) for i in range(s, s + pii.WINDOW)}
    at = text.index(form)
    assert set(range(at, at + len(form))) <= covered


def test_prose_and_dates_are_not_plausible():
    for span in ("look at example.com", "was at home", "meet at the corner"):
        assert not pii.plausible(0, span)
    for span in ("2024-01-15", "15.01.2024", "1999-2004", "15/01/2024", "12345678"):
        assert not pii.plausible(3, span)


def test_tagger_finds_written_out_addresses():
    tagger = Tagger(len(pii.KINDS))
    tagger.train(*pii.labelled_windows(carriers(1)), epochs=pii.EPOCHS)
    names = ["jane", "tom.reed", "maria.k", "peter", "anna.lund", "holger"]
    forms = [f(n) for n in names for f in (lambda n: f"{n} [at] example [dot] com", lambda n: f"{n} (at) mailer.org", lambda n: f"{n} at example dot net")]
    pad = "wor lait sone hert and dlin eto " * 5
    texts = [f"{pad}write to us, {form}. {pad}" for form in forms]
    found = [{t[a:b] for _, a, b in every} for t, (_, every) in zip(texts, pii.find_spans(texts, tagger))]
    hits = sum(form in f for form, f in zip(forms, found))
    assert hits >= 0.7 * len(forms), (hits, len(forms))


class _Exact:
    """Scores of a tagger that tags every character between quotes in each window, cut or not, as an address."""

    tags = 9

    def __init__(self):
        self.best = Tagger(len(pii.KINDS)).best

    def emissions(self, x):
        inside = (x > 64) & (x < 91) | (x == 32) | (x == 14) | (x == 95)  # small letters, @, dots, blanks within an address
        first = inside & ~np.pad(inside, ((0, 0), (1, 0)))[:, :-1]
        scores = np.zeros((*x.shape, 9), np.float32)
        scores[..., 0] = 40.0 * ~inside
        scores[..., 1] = 50.0 * first * ~(np.arange(x.shape[1]) == 0)
        scores[..., 2] = 40.0 * inside
        return scores


def test_a_long_span_is_found_at_every_offset():
    for address in ("first.last @ mail.department.university.example.edu", "a" * 70 + ".b @ " + "mail." * 20 + "example.edu"):
        for offset in range(pii.STRIDE):
            text = f"{'ABC' * 40}{'A' * offset}!{address}!{'ABC' * 60}"
            ((_, every),) = pii.find_spans([text], _Exact())
            at = text.index(address)
            assert every == [(0, at, at + len(address))], offset


def test_the_trained_tagger_finds_a_long_span_at_most_offsets():
    tagger = Tagger(len(pii.KINDS))
    tagger.train(*pii.labelled_windows(carriers(1)), epochs=pii.EPOCHS)
    address, pad = "first.last @ mail.department.university.example.edu", "wor lait sone hert and dlin eto "
    texts = [f"{pad * 4}{'x' * offset} {address} {pad * 4}" for offset in range(pii.STRIDE)]
    found = [address in {t[a:b] for _, a, b in every} for t, (_, every) in zip(texts, pii.find_spans(texts, tagger))]
    assert sum(found) >= 0.8 * len(found), sum(found)
