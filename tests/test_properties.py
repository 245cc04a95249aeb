"""Property tests: Spark operators against small pure-Python models of the rules."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hirelake.operators import salary, skills

LEAD = ',;:!?*-()"\''
TRAIL = '.,;:!?*-()"\''
VOCAB = ["sql", "server", "power", "bi", "ruby", "on", "rails", "c++", ".net", "net", "python",
         "go", "one", "of", "the", "x", "SQL", "Server", "c#"]
DICT = {"a": ["sql", "sql server", "power bi", "ruby", "ruby on rails", "c++", ".net"],
        "b": ["one of", "one of the", "of the", "the", "go", "c#"]}


def py_tokens(text):
    out = []
    for w in re.split(r"[ \t\n]+", text.lower()):
        w = w.lstrip(LEAD).rstrip(TRAIL)
        if w:
            out.append(w)
    return out


def py_tags(text, words):
    toks = py_tokens(text)
    grams = {" ".join(toks[i:i + n]) for n in (1, 2, 3) for i in range(len(toks) - n + 1)}
    hit = grams & {w.lower() for w in words}
    return hit or None


token = st.builds(lambda p, w, s: p + w + s, st.text(LEAD, max_size=2), st.sampled_from(VOCAB),
                  st.text(TRAIL, max_size=2))
texts = st.lists(st.lists(st.tuples(token, st.sampled_from([" ", "  ", "\n", "\t", " \t "])),
                          max_size=14)
                 .map(lambda ps: "".join(t + sep for t, sep in ps)), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_tagger_matches_ngram_model(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    out = skills.tag_keywords(df, "t", keep=["id"], categories=DICT).collect()
    for r in out:
        text = docs[r.id]
        for cat, words in DICT.items():
            got = set(r[cat]) if r[cat] is not None else None
            assert got == py_tags(text, words), (text, cat)
            if r[cat] is not None:
                assert len(r[cat]) == len(set(r[cat]))            # distinct
        every = [w for ws in DICT.values() for w in ws]
        assert (set(r.keywords_all) if r.keywords_all else None) == py_tags(text, every)


def _num(s):
    if s is None:
        return None
    if "K" in s:
        v = _float(s.replace("K", ""))
        return None if v is None else v * 1000.0
    return _float(s)


def _float(s):
    try:
        v = float(s)
    except ValueError:
        return None
    return None if math.isnan(v) or math.isinf(v) else v


def py_salary(text):
    words = text.split(" ")
    pay = words[0].replace(",", "").replace("$", "").replace(" ", "")
    rate = words[2] if len(words) > 2 else None
    if "–" in pay:
        parts = pay.split("–")
        lo, hi = _num(parts[0]), _num(parts[1] if len(parts) > 1 else None)
        avg = (lo + hi) / 2 if lo is not None and hi is not None else None if lo is not None else None
    else:
        lo = hi = None
        avg = _num(pay)
    year = avg if rate is not None and "year" in rate else None
    hour = avg if rate is not None and "hour" in rate else None
    return dict(salary_pay=pay, salary_rate=rate, salary_avg=avg, salary_min=lo, salary_max=hi,
                salary_year=year, salary_hour=hour)


pay_text = st.text("0123456789.,K$–-", min_size=0, max_size=9)
salary_text = st.builds(lambda p, r: f"{p} {r}", pay_text,
                        st.sampled_from(["a year", "an hour", "a month", "per day", "", "a"]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(salary_text, min_size=1, max_size=60))
def test_salary_parser_matches_model(spark, texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "job_id string, job_salary string")
    cols = salary.parse_salary_columns("job_salary")
    out = df.select("job_id", *[c.alias(n) for n, c in cols.items()]).collect()
    for r in out:
        expect = py_salary(texts[int(r.job_id)])
        for k, v in expect.items():
            got = r[k]
            if isinstance(v, float) and got is not None:
                assert math.isclose(got, v, rel_tol=1e-12), (texts[int(r.job_id)], k, got, v)
            else:
                assert got == v, (texts[int(r.job_id)], k, got, v)
