"""Quality, toxicity, decontamination and URL verdicts."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidegauge.llm import decontaminate, quality, toxicity, url_filter
from tidegauge.llm.queries import QUERIES, URL_RULES
from tidegauge.llm.text_batches import plain_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text: str | None):
    text = text or ""
    words = WORD.findall(text)
    windows: dict = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.mark.parametrize("table", ["documents", "clashing"])
def test_base_counts(request, table):
    docs = request.getfixturevalue(table)
    got = sorted(tuple(r[c] for c in COUNTS) for r in quality.judge_quality(docs, None).collect())
    assert got == sorted(brute_counts(r["text"]) for r in docs.collect())


def test_base_rules_alone_without_labels(awkward, spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    assert quality.train(awkward, labels) is None and toxicity.train(awkward, labels) is None
    for row in quality.judge_quality(awkward, None).collect():
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert row["kept"] != row["base_failed"]


def held_out(spark, documents, labels, column):
    learned = ~F.expr("crc32(CAST(__key AS STRING)) % 5 = 0")
    checked = labels.filter("crc32(CAST(doc_id AS STRING)) % 5 = 0")
    return learned, {r["doc_id"]: r[column] for r in checked.collect()}


def test_quality_of_rows_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    learned, truth = held_out(spark, docs, labels, "quality")
    model = quality.fit_quality(*quality.labelled_sample(docs, labels, "quality", 1500, 1 << 16, learned))
    got = {r["doc_id"]: r for r in quality.judge_quality(docs, model).collect()}
    right = [(got[d]["chance"] >= 0.5) == bool(q) for d, q in truth.items()]
    assert len(right) > 50 and np.mean(right) >= 0.97


def test_quality_filter_keeps_columns(documents, clashing, no_rows, spark, sf_dir):
    model = quality.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = quality.keep_good(documents, model)
    wanted = {r["doc_id"] for r in quality.judge_quality(documents, model).collect() if r["kept"]}
    assert kept.dtypes == documents.dtypes and {r["doc_id"] for r in kept.collect()} == wanted
    assert quality.keep_good(clashing, model).dtypes == clashing.dtypes
    assert quality.keep_good(clashing, model).count() <= clashing.count()
    assert quality.keep_good(no_rows, model).count() == 0
    assert quality.judge_quality(no_rows, model).count() == 0


def brute_marginals(local, bounds, moves):
    out = []
    for i, j in zip(bounds, bounds[1:], strict=False):
        e = np.stack([np.ones(j - i), np.exp(local[i:j])], axis=1)
        m = np.exp(moves)
        ahead, back = np.zeros_like(e), np.ones_like(e)
        for t in range(j - i):
            ahead[t] = e[t] * (ahead[t - 1] @ m if t else 1)
            ahead[t] /= ahead[t].sum()
        for t in range(j - i - 2, -1, -1):
            back[t] = m @ (e[t + 1] * back[t + 1])
            back[t] /= back[t].sum()
        both = ahead * back
        out += (both[:, 1] / both.sum(axis=1)).tolist()
    return np.array(out)


@pytest.mark.parametrize("sizes", [[1], [0, 5, 0, 130, 1, 64, 0], [63, 64, 65], [500]])
def test_forward_backward(sizes):
    rng = np.random.default_rng(sum(sizes))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    local, moves = rng.normal(0, 2, sum(sizes)), rng.normal(0, 1, (2, 2))
    field = toxicity.Field(np.zeros(2), 0.0, moves)
    got, _, _ = toxicity.marginals(field, local, bounds)
    assert np.allclose(got, brute_marginals(local, bounds, moves))


def test_toxicity_of_rows_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op9_toxic_spans"](spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    truth = np.array([labels[r["doc_id"]]["toxic"] for r in rows])
    said = np.array([r["predicted"] for r in rows])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert (said == truth).mean() >= 0.97 and said[truth == 1].mean() >= 0.85


def test_toxic_offsets_and_odd_rows(spark, clashing, no_rows):
    texts = [prose(i, 40) for i in range(120)]
    marked = [t.replace(" ", " vileword ", 1 + i % 3) if i % 2 else t for i, t in enumerate(texts)]
    field = toxicity.fit_toxicity(plain_texts(pa.array(marked)), np.arange(120) % 2)
    score, spans = toxicity.score_texts(field, plain_texts(pa.array(["\u00e9t\u00e9 Vileword, fine", "fine", ""])))
    assert score[0] > 0.5 > score[1] >= score[2]
    assert spans[0] == [{"start": 4, "end": 13}] and spans[1] == spans[2] == []
    assert toxicity.score_toxicity(clashing, field).count() == clashing.count()
    assert {r["score"] for r in toxicity.score_toxicity(clashing, None).collect()} == {0.0}
    assert toxicity.score_toxicity(no_rows, field).count() == 0


def edit_distance_within(pattern: bytes, text: bytes) -> int:
    """Least edits of the pattern to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def brute_leaks(docs, items):
    """Documents and items of which a segment is within its edit budget."""
    found = set()
    for key, text in docs:
        own, _, _ = decontaminate.plain(*decontaminate.byte_view(plain_texts(pa.array([text], pa.string()))))
        for item, passage in items:
            body, _, _ = decontaminate.plain(*decontaminate.byte_view(plain_texts(pa.array([passage], pa.string()))))
            if len(body) < decontaminate.Q:
                continue
            last = max(0, len(body) - decontaminate.SEGMENT)
            for at in {*range(0, last, decontaminate.STEP), last}:
                segment = body[at : at + decontaminate.SEGMENT].tobytes()
                if edit_distance_within(segment, own.tobytes()) <= decontaminate.budget(len(segment)):
                    found.add((key, item))
    return found


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    items = [(i, prose(500 + i, 14 + 3 * i)) for i in range(8)] + [(90, None), (91, ""), (92, "tiny"), (93, "sh" * 60)]
    docs = []
    for i, (_, passage) in enumerate(items[:8]):
        for edits in (0, 4, 9, 14, 30):
            letters = list(passage)
            for _ in range(edits):
                at = rng.randrange(len(letters))
                letters[at] = rng.choice(["", "q", letters[at] + "x"])
            spaced = "".join(letters).replace(" ", "\n  ", 2)
            docs.append((len(docs), prose(600 + len(docs), 12) + " " + (spaced.upper() if i % 2 else spaced)))
    docs += [(800, None), (801, ""), (802, "sh" * 100), (803, prose(999, 80)), (804, items[3][1]), (804, items[3][1])]
    got = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute_leaks(docs, items)
    texts, passages = dict(docs), dict(items)
    exact = [r for r in got if r["doc_id"] == 804]
    assert len(exact) == 2 and all(texts[804][r["start"] : r["end"]] == passages[3] for r in exact)


def edits_of_any_segment(item: bytes, texts: list[bytes], size: int) -> np.ndarray:
    """For each text, the least edits of ``size`` bytes of the item, from any byte on, to a stretch of it."""
    own = np.frombuffer(item, np.uint8).astype(np.int16)
    segments = np.stack([own[at : at + size] for at in range(len(own) - size + 1)])
    column = np.arange(max(map(len, texts)) + 1)
    body = np.full((len(texts), 1, len(column) - 1), -1, dtype=np.int16)
    for i, t in enumerate(texts):
        body[i, 0, : len(t)] = np.frombuffer(t, np.uint8)
    row = np.zeros((len(texts), len(segments), len(column)), dtype=np.int16)
    for j in range(size):
        new = row + 1
        new[:, :, 1:] = np.minimum(new[:, :, 1:], row[:, :, :-1] + (body != segments[None, :, j, None]))
        row = (np.minimum.accumulate(new - column, axis=2) + column).astype(np.int16)
    return row.min(axis=(1, 2))


def test_quotes_from_anywhere_in_an_item(spark):
    rng = random.Random(8)
    items = [(0, prose(40, 50)), (1, " ".join([prose(41, 5)] * 9)), (2, prose(42, 12) + " " + "ab " * 50 + prose(43, 9))]
    docs, quotes = [], []
    for item, passage in items:
        for size in (87, 92, 96, 100, 104, 110, 116, 124):
            for edits in (0, 0, 0, 4, 9, 10):
                at = rng.randrange(len(passage) - size + 1)
                letters = list(passage[at : at + size])
                for place in rng.sample(range(size), edits):
                    letters[place] = rng.choice(["", "q", letters[place] + "x"])
                if not edits and size >= decontaminate.SEGMENT:
                    quotes.append((len(docs), item))
                docs.append((len(docs), f"{prose(700 + len(docs), 9)} {''.join(letters)} {prose(900 + len(docs), 9)}"))
    got = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    texts = [" ".join(text.split()).encode() for _, text in docs]
    few = edits_of_any_segment(items[0][1].encode()[:99], texts[:2], 96)
    each = [items[0][1].encode()[at : at + 96] for at in range(4)]
    assert few.tolist() == [min(edit_distance_within(s, t) for s in each) for t in texts[:2]]
    expected = set()
    for item, passage in items:
        edits = edits_of_any_segment(" ".join(passage.split()).encode(), texts, 96)
        expected |= {(doc, item) for doc in np.flatnonzero(edits <= 9).tolist()}
    assert set(quotes) <= expected and len(expected) < len(docs)
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected


def test_short_items_with_edits(spark, monkeypatch):
    items = [(n, prose(300 + n, 20)[: n - 1] + "y") for n in range(8, 42)]
    docs = []
    for n, passage in items:
        e = decontaminate.budget(n)
        for edits in (e, e + 1):
            # Evenly spread, so that the pieces between them are as short as can be.
            letters = list(passage)
            for i in range(edits):
                at = (i + 1) * n // (edits + 1)
                letters[at] = ("#", "", letters[at] + "#")[i % 3]
            docs.append((len(docs), f"{prose(400 + len(docs), 6)} {''.join(letters)} {prose(500 + len(docs), 6)}"))
    tables = [
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ]
    got = sorted(map(tuple, decontaminate.leaks(*tables).collect()))
    expected = brute_leaks(docs, items)
    assert {(2 * (n - 8), n) for n, _ in items} <= expected
    assert {r[:2] for r in got} == expected
    assert {r["doc_id"] for r in decontaminate.drop_leaked(*tables).collect()} == {d for d, _ in docs} - {d for d, _ in expected}
    # In smaller parts the same.
    index = decontaminate.build_index(items, decontaminate.SHORT_Q)
    texts = plain_texts(pa.array([t for _, t in docs]))
    whole = decontaminate.find_leaks(index, texts)
    monkeypatch.setattr(decontaminate, "PAIRS", 3)
    assert decontaminate.find_leaks(index, texts) == whole and whole


def test_leaks_in_slices_and_odd_tables(spark, documents, clashing, no_rows, sf_dir, monkeypatch):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.leaks(documents, items).collect()))
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 3000)
    assert sorted(map(tuple, decontaminate.leaks(documents, items).collect())) == whole and whole
    clean = decontaminate.drop_leaked(documents, items)
    dirty = {r[0] for r in whole}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in documents.collect()} - dirty
    assert decontaminate.drop_leaked(clashing, items).dtypes == clashing.dtypes
    assert decontaminate.drop_leaked(clashing, items).count() == clashing.count()
    assert decontaminate.leaks(no_rows, items).count() == 0
    assert decontaminate.leaks(documents, items.limit(0)).count() == 0
    assert decontaminate.drop_leaked(documents, items.limit(0)).count() == documents.count()


def brute_verdict(url: str | None):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = re.split(r"[?#]", rest[cut:])[0]
    fits = [
        r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.NET/en/1?x=1", "http://a.b.example.net/en/", "http://net/", "http://net",
    "http://dotnet/", "http://x.net?q=/en/", "http://x.net#/a", "http://x.net/a://b/c", "ftp://example.com/de/x#f", "://x.org/fr/1",
    "http://example.com/fr/", "http://\u00c9.org/fr/", "http://a.org/fr", "http://u@x.net:80/", "http://x.net/" + "p/" * 5000,
    "http://a\nb.net/c\nd", "http://example.net/en/", "http://example.net/en/",
]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id bigint, url string, host string, rule string")
    rows = url_filter.judge_urls(pages, URL_RULES).orderBy("page_id").collect()
    for row, url in zip(rows, URLS, strict=True):
        host, path, rule, verdict = brute_verdict(url)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule), url
        assert row["verdict"] == verdict if verdict else row["verdict"] in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, []).collect()} == {"allow"}


def test_trees_as_columns_equal_trees(spark):
    rng = np.random.default_rng(4)
    cells = rng.integers(0, url_filter.BINS, (400, 3))
    blocked = (cells[:, 0] + cells[:, 1] > 7).astype(float)
    base, trees = url_filter.grow_trees(cells, np.ones(400), blocked)
    df = spark.createDataFrame([(i, *map(int, c)) for i, c in enumerate(cells)], "i int, b0 int, b1 int, b2 int")
    bins = [F.col(f"b{i}") for i in range(3)]
    rows = df.select(*[url_filter.tree_column(t, bins).alias(f"t{i}") for i, t in enumerate(trees)], "i").collect()
    for r in rows:
        assert [r[f"t{i}"] for i in range(len(trees))] == [url_filter.tree_value(t, cells[r["i"]]) for t in trees]
    margin = base + np.array([sum(url_filter.tree_value(t, c) for t in trees) for c in cells])
    assert ((margin > 0) == (blocked > 0)).mean() > 0.9


def test_every_suffix_has_its_statistic(spark):
    # 24 suffixes, half of them bad, and nothing else that tells bad from good.
    rules, rows = [], []
    for n in range(24):
        top = "".join("abcdefghij"[int(c)] for c in f"{n:03d}")
        rules.append(url_filter.Rule(f"ruled.{top}", "/", "block" if n % 2 else "allow"))
        rows += [(len(rows) + k, f"http://h{k}.ruled.{top}/x/{k}", n) for k in range(8)]
        rows.append((len(rows), f"http://free.{top}/x/1", n))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, n int")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, rules).collect()}
    free = [(got[i]["verdict"], n) for i, u, n in rows if "free" in u]
    assert len(got) == len(rows) and all(got[i]["rule"] is None for i, u, _ in rows if "free" in u)
    assert sum(v == ("block" if n % 2 else "allow") for v, n in free) >= 0.95 * len(free)


def test_url_scores_of_unseen_hosts(spark):
    """Held-out accuracy on the given pages: hosts of one fold are not learned from."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    unseen = F.pmod(F.xxhash64("host"), F.lit(4)) == 0
    judged = url_filter.judge_urls(pages, URL_RULES, unseen=unseen).filter(unseen & F.col("rule").isNotNull())
    rows = [(r["score"] >= 0.5, brute_verdict(f"http://{r['host']}{r['path']}")[3] == "block") for r in judged.collect()]
    right, blocked = sum(a == b for a, b in rows), sum(b for _, b in rows)
    print(f"held out: {len(rows)} URLs, accuracy {right / len(rows):.3f}, all one verdict {max(blocked, len(rows) - blocked) / len(rows):.3f}")
    assert right >= max(blocked, len(rows) - blocked)


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        bad = i % 2
        digits = "".join(rng.choice("0123456789") for _ in range(12 if bad else 1))
        rows.append((i, f"http://{'spam' if bad else 'fine'}.test/{'a/' * (6 if bad else 1)}{digits}"))
    rows += [(1000 + i, f"http://other.test/{'a/' * 6}{'7' * 12}") for i in range(3)]
    rows += [(2000 + i, "http://other.test/a/3") for i in range(3)]
    rules = [url_filter.Rule("spam.test", "/", "block"), url_filter.Rule("fine.test", "/", "allow")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, rules).collect()}
    assert {got[k] for k in got if 1000 <= k < 2000} == {"block"}
    assert {got[k] for k in got if k >= 2000} == {"allow"}


def test_scoring_has_no_python_stage(spark, sf_dir):
    for name in ("op10_url_verdicts", "op5_perspectives"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
