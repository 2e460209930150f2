"""Source divergence against its SQL and against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import divergence
from tidegauge.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import DOCS, prose


def by_sql(documents):
    engine = duckdb.connect()
    engine.register("documents", documents.select("doc_id", "text", "lang", "source").toArrow())
    result = engine.execute(ORACLE_SQL["op11_source_divergence"])
    names = [c[0] for c in result.description]
    return Counter(tuple(dict(zip(names, row, strict=True)).values()) for row in result.fetchall()), names


def plainly(rows, min_docs=3, top=200):
    """The definition, term by term."""
    count, docs = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in docs[lang].items() if n >= min_docs) for lang, _ in groups}
    out = Counter()

    def shares(counts, terms):
        size = sum(counts[t] for t in terms) + len(terms)
        return {t: 1 + 10**9 * (counts[t] + 1) // size for t in terms}

    for lang, source in groups:
        terms = kept[lang]
        total = Counter()
        for (other, _), counts in count.items():
            if other == lang:
                total.update(counts)
        p, q = shares(count[lang, source], terms), shares(total, terms)
        scored = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode()) for t in terms if count[lang, source][t] and p[t] > q[t]]
        for rank, (value, term) in enumerate(sorted(scored)[:top], 1):
            out[lang, source, "term", term.decode(), -value, rank] += 1
        pairs = []
        for other in sorted(s for g, s in groups if g == lang and s != source):
            r = shares(count[lang, other], terms)
            pairs.append((-sum((p[t] - r[t]) ** 2 // r[t] for t in terms), other.encode()))
        for rank, (value, other) in enumerate(sorted(pairs), 1):
            out[lang, source, "pair", other.decode(), -value, rank] += 1
    return out


def plain(df):
    return Counter(map(tuple, df.collect()))


def test_audit_equals_sql(spark, sf_dir):
    expected, names = by_sql(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert plain(QUERIES["op11_source_divergence"](spark, sf_dir).select(names)) == expected


@pytest.fixture(scope="module")
def mixed(spark, awkward):
    """Sources that share some terms, ties, a group without terms, a lone source."""
    rows = [(100 + i, prose(i % 23, 30) + " KÉY İx", "en", "abc"[i % 3], 0) for i in range(60)]
    rows += [(200 + i, f"tie{i % 5:c} " * 3 + "only", "fr", "xy"[i % 2], 0) for i in range(20)]
    rows += [(300, "1 2 3", "en", "bare", 0), (301, "few words", "de", "p", 0), (302, "other", "de", "q", 0)]
    rows += [(303, None, None, None, None), (304, "a[b\x7fc`d{e", "en", "a", 0)] + [(305, "lone lone", "it", "z", 0)] * 3
    return awkward.unionByName(spark.createDataFrame(rows, DOCS))


def test_audit_of_odd_rows(mixed):
    got = plain(divergence.divergence_audit(mixed))
    assert got == plainly([(r["text"], r["lang"], r["source"]) for r in mixed.collect()])
    assert got == by_sql(mixed)[0]
    pairs = [r for r in got if r[2] == "pair" and r[0] == "de"]
    assert sorted(pairs) == [("de", "p", "pair", "q", 0, 1), ("de", "q", "pair", "p", 0, 1)]
    assert not [r for r in got if r[0] == "it" and r[2] == "pair"]


def test_ranks_are_cut_in_the_middle_of_a_cell(mixed):
    rows = [(r["text"], r["lang"], r["source"]) for r in mixed.collect()]
    for top in (1, 3, 7):
        assert plain(divergence.divergence_audit(mixed, 2, top)) == plainly(rows, 2, top)


def test_large_counts_stay_exact(spark):
    n, size = 9 * 10**15 + 7, 10**17 + 3
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(size), F.lit(11)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 1) // (size + 11)


def test_audit_takes_clashing_and_empty_tables(clashing, awkward, no_rows):
    assert plain(divergence.divergence_audit(clashing)) == plain(divergence.divergence_audit(awkward))
    assert divergence.divergence_audit(no_rows).count() == 0
