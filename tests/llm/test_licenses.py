import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.llm import licenses
from linkwright.llm.words import hashes_of

TOY = """alpha beta <<beginOptional>>gamma <<beginOptional>>delta<<endOptional>><<endOptional>> epsilon
    <<var;name="x";words="0-2">> zeta <<var;name="y";words="1-1">> eta<<beginOptional>> theta<<endOptional>>"""


def test_automata_accept_what_the_pattern_accepts():
    draw = random.Random(1)
    automaton, pattern = licenses.Automaton("toy", TOY), re.compile(licenses.template_pattern(TOY))
    vocabulary = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "x"]
    accepted = 0
    for _ in range(6000):
        w = ["alpha", "beta", *draw.choices(vocabulary, k=draw.randint(0, 3)), "epsilon", *draw.choices(vocabulary, k=draw.randint(0, 2)),
             "zeta", draw.choice(vocabulary), "eta", *draw.choices(vocabulary, k=draw.randint(0, 2))]
        if draw.random() < 0.2:
            w.pop(draw.randrange(len(w)))
        text = " ".join(w) + " "
        ends = [k for k in range(1, len(w) + 1) if pattern.fullmatch(" ".join(w[:k]) + " ")]
        got = automaton.longest(np.concatenate(hashes_of(w, "plain")))
        assert got == (max(ends) if ends else None), text
        accepted += bool(ends)
    assert 500 < accepted < 5500


@pytest.mark.parametrize("bad", ["a <<endOptional>>", "<<beginOptional>>a", '<<var;name="x";words="0-1">> a', ""])
def test_broken_markup_is_refused(bad):
    with pytest.raises(ValueError):
        licenses.Automaton("bad", bad)


def test_report(spark):
    mit = re.sub("<<[^>]*>>", "this thing", licenses.TEMPLATES["mit-text"].replace("<<beginOptional>>(including the next paragraph)<<endOptional>>", ""))
    rows = [
        (1, "Released under the MIT License."), (2, "released under the terms of the mit-LICENSE; MIT license"), (3, "MIT"), (4, None), (5, ""),
        (6, mit.upper()), (7, mit.replace("free of charge", "free of any charge")), (8, "the gnu lesser general public license, version"),
        (9, "licensed under the terms of the GNU Lesser General Public License, version 3"), (1, "Released under the MIT License."),
        (None, "Licensed under the Apache License, Version 2.0"), (10, "x " * 50_000 + "apache license " * 3), (11, "mit licenses amit license mité license")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("found", F.lit("own")).withColumn("score", F.lit(9))
    got = {r["doc_id"]: tuple(r)[2:] for r in licenses.report(docs).collect()}
    assert got == {
        1: (1, 3, 3, "mit", "mit,mit-notice", 1.0), 2: (2, 6, 8, "mit", "mit,mit-notice", 1.0), 3: (0, None, None, "", "", 0.0),
        4: (0, None, None, "", "", 0.0), 5: (0, None, None, "", "", 0.0), 6: (0, None, None, "", "mit-text", 1.0),
        7: (0, None, None, "", "", 0.0), 8: (1, 3, 3, "gpl", "gpl", 0.5), 9: (1, 8, 8, "gpl", "gpl,gpl-notice", 1.0),
        None: (1, 3, 3, "apache", "apache,apache-notice", 1.0), 10: (3, 50_000, 50_004, "apache", "apache", 0.5), 11: (0, None, None, "", "", 0.0)}
    assert licenses.report(docs).count() == len(rows) and licenses.report(docs.filter("false")).count() == 0
