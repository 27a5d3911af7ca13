"""Whole licenses: the automata against regular expressions made from the same markup."""
import random
import re

import pytest

from lineark.llm.license_scan import PHRASES, TEMPLATES, Automaton, license_scan
from lineark.llm.license_texts import LICENSES

PART = re.compile(r"<<beginOptional>>|<<endOptional>>|<<var[^>]*>>|[^<]+")
WORD = re.compile(r"[a-z0-9\u0080-￿]+")


def parts(template):
    for p in PART.findall(template):
        if p.startswith("<<var"):
            low, high = re.search(r"min=(\d+)", p), re.search(r"max=(\d+)", p)
            yield "var", (int(low[1]) if low else 1, int(high[1]) if high else 3)
        elif p.startswith("<<"):
            yield p, None
        else:
            yield "words", WORD.findall(p.lower())


def pattern(template):
    """The template as a regular expression over words that each end in a blank."""
    out = ""
    for kind, x in parts(template):
        out += {"<<beginOptional>>": "(?:", "<<endOptional>>": ")?"}.get(kind) or (
            "(?:[^ ]+ ){%d,%d}" % x if kind == "var" else "".join(re.escape(w) + " " for w in x))
    return re.compile(out)


def longest(rx, words, at):
    if not rx.match("".join(w + " " for w in words[at:])):
        return None
    return max(e for e in range(at, len(words) + 1) if rx.fullmatch("".join(w + " " for w in words[at:e])))


def instance(r, template):
    """A random text that the template accepts, and the places of mandatory words inside fixed runs
    (a word beside a replaceable region may be taken by that region)."""
    out, must, stack = [], [], [True]
    for kind, x in parts(template):
        if kind == "<<beginOptional>>":
            stack.append(stack[-1] and r.random() < 0.5)
        elif kind == "<<endOptional>>":
            stack.pop()
        elif stack[-1] and kind == "var":
            out += [r.choice(["acme", "jane", "2019", "team"]) for _ in range(r.randint(*x))]
        elif stack[-1]:
            if len(stack) == 1:
                must += range(len(out) + 1, len(out) + len(x) - 1)
            out += x
    return out, must


def test_small_templates_against_expressions():
    r = random.Random(7)
    for _ in range(300):
        made, depth = [], 0
        for _ in range(r.randint(1, 6)):
            made.append(r.choice(["a ", "b ", "a b ", "<<var;min=0;max=2>> ", "<<var>> ", "<<var;min=2;max=2>> ", "<<beginOptional>>"]))
            if made[-1] == "<<beginOptional>>":
                made.append(r.choice(["a ", "b a ", "<<beginOptional>> b <<endOptional>> a "]) + "<<endOptional>> ")
        template = "c " + "".join(made)
        a, rx = Automaton(template), pattern(template)
        for _ in range(20):
            words = r.choices("abc", k=r.randint(0, 9))
            for i in range(len(words) + 1):
                assert a.match([w.encode() for w in words], i) == longest(rx, words, i), (template, words, i)


@pytest.mark.parametrize("label,template", LICENSES, ids=[x for x, _ in LICENSES])
def test_each_license_against_its_expression(label, template):
    r = random.Random(label)
    a, rx = Automaton(template), pattern(template)
    for k in range(6):
        words, must = instance(r, template)
        if k >= 3:                              # a mandatory word goes, changes or stands twice
            at = r.choice(must)
            words[at:at + 1] = [[], ["other"], [words[at]] * 2][k - 3]
        words = ["before"] + words + ["after", "it"]
        got = [a.match([w.encode() for w in words], i) for i in range(len(words))]
        assert got == [longest(rx, words, i) for i in range(len(words))]
        assert (max((e - i for i, e in enumerate(got) if e), default=0) >= len(must)) == (k < 3)


def test_scan_of_whole_licenses(shipped):
    r = random.Random(3)
    every = TEMPLATES + LICENSES
    rxs = [(label, pattern(t)) for label, t in every]
    texts = []
    for _, template in LICENSES:
        words, must = instance(r, template)
        texts.append(words)
        texts.append([w for i, w in enumerate(words) if i != r.choice(must)] + ["end"])
        at = r.choice(must)
        texts.append(["x"] * 50 + words[:at] + words[at + 1:])
        texts.append(words + ["and"] + instance(r, r.choice(LICENSES)[1])[0])
    rows = [(i, " ".join(w).upper() if i % 2 else "\n* ".join([" ".join(w[:9]), " ".join(w[9:])])) for i, w in enumerate(texts)]
    got = {x.doc_id: x for x in license_scan(shipped.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, w in enumerate(texts):
        joined = "".join(x + " " for x in w)
        want = {label for label, rx in rxs if re.search("(?<![^ ])" + rx.pattern, joined)}
        base = {label for p, label in PHRASES if f" {p} " in " " + joined}
        assert got[i].labels == ",".join(sorted(want | base)), joined
        assert got[i].base_labels == ",".join(sorted(base)) and got[i].n_words == len(w)
        assert got[i].score == (1.0 if want else 0.5 if base else 0.0)
        assert all(got[i].n_words >= s.end > s.start >= 0 for s in got[i].spans)
    assert {x for g in got.values() for x in g.labels.split(",")} >= {label for label, _ in LICENSES}
