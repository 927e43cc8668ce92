"""Stems of words whose stems are published with the algorithm, and of words with y, accents and few letters."""

from __future__ import annotations

from millrace.operators.stems import stem_terms

PUBLISHED = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing
conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky
relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ vileli vile
analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal
sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
probate probat rate rate cease ceas controll control roll roll""".split()
OTHERS = {"saying": "sai", "toy": "toi", "yes": "ye", "syzygy": "syzygi", "Élèves": "elev", "as": "as", "ÿ": "y", "archaeology": "archaeolog", "running": "run", "generalizations": "gener", "oscillators": "oscil"}


def test_published_stems(spark):
    pairs = dict(zip(PUBLISHED[::2], PUBLISHED[1::2], strict=True)) | OTHERS
    rows = [(t,) for t in pairs] * 2 + [(None,)]
    got = {r["term"]: r["stem"] for r in stem_terms(spark.createDataFrame(rows, "term string")).collect()}
    assert {k: (v, pairs[k]) for k, v in got.items() if v != pairs[k]} == {} and len(got) == len(pairs)
