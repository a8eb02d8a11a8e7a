"""Citation strings, sections, references and outcome windows as Columns, against plain loops and given cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from screenloom.functions import documents as D


def one(spark, f, values, **k):
    return [r[0] for r in spark.createDataFrame(list(enumerate(values)), "i int, t string").orderBy("i").select(f(F.col("t"), **k)).collect()]


CLEAN = {
    "[2] L.J.T. Balter, et al., Low-grade inflammation decreases recognition": "Low-grade inflammation decreases recognition",
    "and D. Tzovaras, Emotion recognition in music": "Emotion recognition in music",
    "3. M. Moieni, M.R. Irwin, I. Jevtic, Trait sensitivity": "Trait sensitivity",
    "Moieni M.R., Irwin A., Social pain": "Social pain",
    "[12] Angry Men": "[12] Angry Men", "12 Angry Men": "12 Angry Men", "3. Methods for Estimating Prevalence": "3. Methods for Estimating Prevalence",
    "And Then There Were None": "And Then There Were None", "et al., A title": "et al., A title", "M. Moieni, ": "M. Moieni,", "": "", None: "", "  Nudge ": "Nudge",
}
FRAGMENTS = {"M. Moieni, M.R": True, "and D. Tzovaras, Is it so": True, "": True, None: True, "J.": True, "Nudge": False, "Grit, again": False, "12 Angry Men": False, "[1] A. Bee, x": True}
USABLE = {"Nudge": False, "A good long title": True, "n/a": False, "M. Moieni, Trait sensitivity to pain": False, "Влияние сна на память": True, "1. A. B.": False}
STRIPPED = {
    "Zhong, Bohns, & Gino (2010) Good lamps are the best police": "Good lamps are the best police", "Wilson et al. (2017, JPSP): The title of that paper": "The title of that paper",
    "Smith, 2007, The title of another paper": "The title of another paper", "Smith 2007 The title of a third paper": "The title of a third paper", "Ramscar et al. (2010)": "Ramscar et al. (2010)", "No citation here at all": "No citation here at all", None: "",
}
BARE = {"Ramscar et al. (2010)": True, "Job, Dweck, and Walton (2010), Study 1": True, "Vess (2012, PS, Study 1)": True, "Zhong, Bohns, & Gino (2010) Good lamps are the best police": False, "The original paper": False, "": False}


@pytest.mark.parametrize("f,cases", [(D.clean_title, CLEAN), (D.is_fragment, FRAGMENTS), (D.usable_title, USABLE), (D.without_citation, STRIPPED), (D.is_bare_citation, BARE)])
def test_citation_strings(spark, f, cases):
    assert dict(zip(cases, one(spark, f, cases), strict=True)) == cases


def test_sections_and_references(spark):
    text = "A title\n1. Methods:\nWe did it.\n\n  RESULTS\nIt was.\n3 References \n[1] Smith, J. (1999). The big effect. Journal.\n2) Lee, K. & Ng, P.\n(2004a) Small\nthings. x\nno year here\nÉtienne, A. (2001) Été."
    got = one(spark, D.sections, [text, None, "", "plain", "Methods\n\n"])
    assert [(s.heading, s.body.split("\n")[0]) for s in got[0]] == [("", "A title"), ("methods", "We did it."), ("results", "It was."), ("references", "[1] Smith, J. (1999). The big effect. Journal.")]
    assert [[(s.heading, s.body) for s in x] for x in got[1:]] == [[], [], [("", "plain")], []]
    listed = one(spark, D.references, [got[0][-1].body, None, ""])
    assert [tuple(r) for r in listed[0]] == [("Smith, J.", 1999, "The big effect"), ("Lee, K. & Ng, P.", 2004, "Small things"), ("Étienne, A.", 2001, "Été")]
    assert listed[1:] == [[], []]


def window(text, most):
    """The outcome window by loops."""
    if not (text or "").strip():
        return "", "none"
    flags = re.I | re.M
    heads = list(re.finditer(r"^\s*(?:\d+(?:\.\d+)*\.?\s+)?(?:references|bibliography)\s*:?\s*$", text, flags))
    body = text[: heads[-1].start()] if heads else text
    body = body if body.strip() else text
    found = [m for m in re.finditer(r"^[^\S\n]{0,8}(?:\d+[.\s]{1,3})?(?:general )?(?:discussion|conclusions?)[^\S\n]*[:.]?[^\n]{0,40}$", body, flags) if m.start() >= 0.4 * len(body)]
    for m in reversed(found):
        block = body[m.start() :].strip()
        if len(block) >= 300:
            if len(block) <= most:
                return block, "discussion"
            head = int((most - 3) * 0.6)
            return block[:head].strip() + "\n…\n" + block[head - (most - 3) :].strip(), "discussion"
    return body[-most:].strip(), "tail"


def test_outcome_windows(spark):
    dice = random.Random(9)
    lines = ["Some words of a text that goes on and on, as they do.", "Discussion", " 4. General discussion", "Conclusions: we find", "In the discussion we return", "References", "", "😀 é", "x" * 200]
    texts = ["\n".join(dice.choice(lines) for _ in range(dice.randint(0, 25))) for _ in range(150)] + [None, "", "References\n", "\nReferences\nx"]
    got = [tuple(r) for r in one(spark, D.outcome_text, texts, most=500)]
    assert got == [window(t, 500) for t in texts]
    assert {o for _, o in got} == {"none", "discussion", "tail"}
