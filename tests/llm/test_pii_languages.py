"""Disguises of four languages, long digit parts, runs of blanks; random disguises map back to their source."""

from __future__ import annotations

import random
import time

import pytest

from hexvault.llm import pii


def added(text):
    base, every = pii.spans(text)
    return {(k, text[a:b]) for k, x, y in zip(pii.KINDS, base, every) for a, b in y if (a, b) not in x}


def test_parts_of_any_number_of_zeros_are_an_ip(spark):
    zeros = "0" * 5000
    assert pii.spans(f"{zeros}.1.1.1 x")[0][1] == [(0, 5006)]
    assert pii.spans(f"{zeros}.1.1.256")[0][1] == [] == pii.spans(f"9{zeros}.1.1.1")[0][1]
    table = spark.createDataFrame([(1, f"{zeros}255.{zeros}.1.1"), (2, f"{zeros}256.1.1.1")], "doc_id long, text string")
    assert [r.n_ip for r in pii.personal_data(table).orderBy("doc_id").collect()] == [1, 0]
    assert pii.masked(table).orderBy("doc_id").first().text == "[IP]"


@pytest.mark.parametrize("kind, found", [
    ("email", "juan arroba ejemplo punto es"), ("email", "max klammeraffe firma punkt de"),
    ("email", "jean arobase exemple point fr"), ("email", "mario at azienda dot it"), ("email", "eva arroba casa.mx"),
    ("email", "ann       at     host    dot      kr"), ("email", "ann [      at      ] host [    dot   ] be"),
    ("ip", "uno nueve dos punto uno seis ocho punto cero punto uno"), ("ip", "eins null punkt zwei punkt drei punkt vier"),
    ("ip", "UN POINT ZÉRO POINT DEUX POINT UN"), ("ip", "FÜNF punkt eins punkt zwei punkt drei"), ("ip", "un deux point zéro point un point neuf"), ("ip", "one dot two dot three dot four"),
    ("phone", "plus vier neun drei null eins zwei drei vier fünf sechs")])
def test_disguises(kind, found):
    text = f"Ünder {found}, so."
    assert (kind, found) in added(text)


@pytest.mark.parametrize("text", ["we looked at the dot in the plan", "at a point of it", "null und eins",
                                  "un point de vue", "six at ten", "one two"])
def test_plain_prose_is_left_alone(text):
    assert not added(text)


def test_random_disguises_map_back_to_their_source():
    """A plain second version writes the disguise, so it knows where it stands."""
    rnd = random.Random(11)
    digits = ["zero one two three four five six seven eight nine".split(),
              "zéro un deux trois quatre cinq six sept huit neuf".split(),
              "null eins zwei drei vier fünf sechs sieben acht neun".split(),
              "cero uno dos tres cuatro cinco seis siete ocho nueve".split()]
    at, dot = ["at", "arobase", "klammeraffe", "arroba"], ["dot", "point", "punkt", "punto"]
    for _ in range(400):
        k = rnd.randrange(4)
        blanks = lambda: " " * rnd.choice((1, 1, 2, 7))
        word = lambda n: "".join(rnd.choice("bcdfghk") for _ in range(n))
        if rnd.random() < 0.5:
            kind = "ip"
            parts = [" ".join(digits[k][int(d)] for d in str(rnd.randint(0, 255))) for _ in range(4)]
            found = parts[0] + "".join(f"{blanks()}{dot[k]}{blanks()}{p}" for p in parts[1:])
        else:
            kind = "email"
            found = f"{word(5)}{blanks()}{at[k]}{blanks()}{word(6)}{blanks()}{dot[k]}{blanks()}{word(rnd.randint(2, 4))}"
        text = f"é{rnd.choice(['', chr(0x1f600)])} x; {found}. \n"
        assert (kind, found) in added(text), text


@pytest.mark.parametrize("text", [" " * 10**6 + "at", "[ " * 200_000 + " " * 200_000, "a-at-" * 100_000,
                                  "a" + " " * 400_000 + "dot" + " " * 400_000 + "b", ("one" + " " * 1000) * 500])
def test_time_is_linear(text):
    begun = time.time()
    pii.spans(text)
    assert time.time() - begun < 10
