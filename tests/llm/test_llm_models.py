import binascii
import collections
import math
import random
import re

import numpy as np
import pytest
from llm_fixtures import EXTRA, corpus, frame, text_of
from pyspark.sql import functions as F

from hammerprice.llm import neighbours, quality, toxicity, url_filter
from hammerprice.llm.queries import QUERIES, URL_RULES


def ordered(rows):
    return sorted(rows, key=repr)


# --- quality ---


def labelled_texts(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(30, 150))]
        clean = ". ".join(" ".join(words[a : a + 9]).capitalize() for a in range(0, len(words), 9)) + "."
        kind = i % 8
        junk = {
            0: " ".join(word.upper() + "!!" for word in words),
            1: " ".join(word + "***" for word in words),
            2: " | ".join(words),
            3: " ".join(word for word in words[:6] for _ in range(20)),
        }
        out.append((i, junk.get(kind, clean), 0 if kind in junk else 1))
    return out


def test_quality_finds_junk_and_keeps_clean_texts(spark):
    rows = labelled_texts()
    truth = {i: good for i, _, good in rows}
    found = quality.quality(frame(spark, [(i, t) for i, t, _ in rows]).repartition(3)).collect()
    right = collections.Counter((truth[r.doc_id], r.kept) for r in found)
    assert right[1, False] == 0 and right[0, True] <= 6
    assert all(0 <= r.score <= 1 and len(r.votes) == len(quality.LABELLERS) for r in found)


def test_quality_accuracies_are_estimated_from_agreement():
    rng = np.random.default_rng(2)
    n, labellers = 20_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.75
    accuracy = np.linspace(0.65, 0.95, labellers)
    cast = rng.random((n, labellers)) < 0.6
    right = rng.random((n, labellers)) < accuracy
    votes = np.where(cast, np.where(right == good[:, None], 1, -1), 0)
    model = quality.WeakLabels(collections.Counter(map(tuple, votes.tolist())))
    assert abs(model.good - 0.75) < 0.03
    assert np.allclose(list(model.accuracies().values()), accuracy, atol=0.05)
    sure = [model.posterior(tuple(v)) > 0.5 for v in votes[:2000].tolist()]
    assert np.mean(np.array(sure) == good[:2000]) > 0.9


def test_quality_edges(spark):
    assert quality.quality(frame(spark, [])).count() == 0
    rows = corpus()
    found = quality.quality(frame(spark, rows)).collect()
    assert ordered([r.doc_id for r in found]) == ordered([i for i, _ in rows])
    empty = {r.score for r in found if r.doc_id in (60, 61, 62)}
    assert len(empty) == 1
    kept = quality.keep_good(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    assert kept.count() == sum(r.kept for r in found)
    again = quality.quality(frame(spark, rows).repartition(5)).collect()
    assert ordered([(r.doc_id, round(r.score, 9)) for r in again]) == ordered([(r.doc_id, round(r.score, 9)) for r in found])


def test_quality_query_is_accurate(spark, small):
    small = small.replace("0.001", "0.01")
    found = {r.doc_id: r.kept for r in QUERIES["op3_quality"](spark, small).collect()}
    labels = spark.read.parquet(f"{small}/labels.parquet").where("quality IS NOT NULL").collect()
    right = collections.Counter((r.quality, found[r.doc_id]) for r in labels)
    assert len(found) == spark.read.parquet(f"{small}/documents.parquet").count()
    assert right[1, False] <= 0.02 * (right[1, True] + right[1, False])
    assert right[0, False] >= 0.7 * (right[0, True] + right[0, False])


# --- toxicity ---


SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'<|>")
BETWEEN = f"(?<=[a-zß-öø-ÿÀ-ÖØ-Þ])(?=[{re.escape(SIGNS)}])|(?<=[{re.escape(SIGNS)}])(?=[a-zß-öø-ÿÀ-ÖØ-Þ])"


def split_words(text):
    """Words by regular expressions: runs without white space, cut between letters and signs."""
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w.encode() for run in re.findall(r"[^\x20\x09-\x0d]+", lower) for w in re.split(BETWEEN, run)]


@pytest.mark.parametrize("common", [0, 4, 10**6])  # no list is long, some, all of two examples
@pytest.mark.parametrize("block", [2, 16, 1000])
def test_nearest_examples_are_exact(block, common, monkeypatch):
    monkeypatch.setattr(toxicity, "COMMON", common)
    rng = np.random.default_rng(block)
    n, terms, k = 150, 12, 7
    counts = np.where(rng.random((n, terms)) < 0.3, rng.integers(1, 4, (n, terms)), 0)
    counts[:, 0] += counts.sum(axis=1) == 0
    dense = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0)
    scale = 1 / np.linalg.norm(dense, axis=1)
    dense *= scale[:, None]
    ids = rng.permutation(n)
    index = toxicity.BlockMaxIndex(ids, np.zeros(n, np.int64), np.ones(2), np.ones(terms), block)
    examples, found = np.nonzero(dense)
    index.fill(examples, found, counts[examples, found], scale)
    queries = np.concatenate([dense[:60], np.zeros((1, terms))])
    which, asked = np.nonzero(queries)
    batch = index.nearest_of(which, asked, queries[which, asked], len(queries), k)
    for query, (hit, cosine) in zip(queries, batch, strict=True):
        scores = dense @ query
        order = np.lexsort((ids, -np.round(scores, 12)))
        wanted = [i for i in order[:k] if scores[i] > 0]
        assert ids[hit].tolist() == ids[wanted].tolist()
        assert np.allclose(cosine, scores[wanted])


@pytest.mark.parametrize("n", [64, 57, 16, 1])
def test_blocks_hold_examples_of_a_kind(n):
    rng, kinds, block = np.random.default_rng(n), np.arange(n) % 2, 16
    words = rng.permutation(200).reshape(2, 100)  # of either kind, their keys mixed
    held = [np.sort(rng.choice(words[kind], 30, replace=False)) for kind in kinds]
    first, terms = 30 * np.arange(n + 1), np.concatenate(held)
    examples = toxicity.Examples(rng.permutation(n), np.zeros(n, np.int64), first, terms, np.ones(len(terms), np.int64))
    idf = np.ones(len(examples.keyed()))
    index = examples.weighted(idf, np.ones(2), block).index()
    assert sorted(index.ids) == list(range(n))
    kind_of = dict(zip(examples.ids.tolist(), kinds.tolist(), strict=True))
    mixed = [len({kind_of[i] for i in index.ids[a : a + block].tolist()}) == 2 for a in range(0, n, block)]
    assert sum(mixed) <= bool(kinds.sum() % block)  # at most where one kind ends


def toxic_rows(n=240, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = i % 6 == 0
        words = text_of(rng, rng.randint(20, 90)).split()
        if toxic:
            words[3:3] = rng.sample(["vilest", "scoundrel", "rotten", "grubling"], 3)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.mark.parametrize("per_class", [4000, 25])  # 25: fewer examples than labels of either class
def test_toxicity_equals_brute_force_over_all_terms(spark, per_class):
    rows = toxic_rows()
    rows += [(1000, "The gnarlword, abcdefghijkl fox", 1), (1001, "gnarlwords lazy (x)", 0), (1002, "a dog of lazy mornings", 0)]
    learned = {i: y for i, _, y in rows if i % 5 or i == 1000}
    documents = frame(spark, [(i, t) for i, t, _ in rows]).repartition(3)
    labels = spark.createDataFrame(list(learned.items()), "doc_id long, label int")
    found = {r.doc_id: r for r in toxicity.toxicity(documents, labels, per_class=per_class, k=9).collect()}
    bags = {i: collections.Counter(f for w in split_words(t) for f in toxicity.features(w)) for i, t, _ in rows}
    n, prior, totals = collections.Counter(f for b in bags.values() for f in b), sum(learned.values()) / len(learned), {}
    hashed = {r.doc_id: r.h for r in labels.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    chosen = []
    for y in (0, 1):
        of_class = sorted((i for i in learned if learned[i] == y), key=lambda i: (hashed[i], i))
        chosen, totals[y] = chosen + of_class[:per_class], len(of_class) / min(per_class, len(of_class))
    share = sum(learned[i] for i in chosen) / len(chosen)
    of = {y: collections.Counter(f for i in chosen if learned[i] == y for f in bags[i]) for y in (0, 1)}
    weight = {}
    for f in n:
        known = f in of[0] or f in of[1]
        odds = (of[1][f] + toxicity.EVIDENCE * share) / (of[0][f] + toxicity.EVIDENCE * (1 - share))
        idf = math.log((1 + len(rows)) / (1 + (n[f] if known else 1))) + 1
        weight[f] = idf * (1 + abs(math.log(odds * (1 - share) / share)) if known else 1)
    vecs = {}
    for i, bag in bags.items():
        vec = {f: (1 + math.log(c)) * weight[f] for f, c in bag.items()}
        vecs[i] = {f: x / math.sqrt(sum(x * x for x in vec.values())) for f, x in vec.items()}
    for i, vec in vecs.items():
        scores = {j: sum(x * vecs[j].get(f, 0.0) for f, x in vec.items()) for j in chosen}
        near = sorted((-round(x, 12), j) for j, x in scores.items() if x > 0)[:9]
        mass, toxic = sum(-x * totals[learned[j]] for x, j in near), sum(-x * totals[1] for x, j in near if learned[j])
        assert abs(found[i].score - (toxic + toxicity.SMOOTHING * prior) / (mass + toxicity.SMOOTHING)) < 1e-6
        assert found[i].evidence == [j for _, j in near[:3]]
    plain = [found[i] for i, _, y in rows if not y and i < 1000]
    assert per_class < 4000 or len({r.score for r in plain}) == len(plain)  # no two without a telling word are the same
    held = [(found[i].score >= 0.3) == bool(y) for i, _, y in rows if i % 5 == 0 and i < 1000]
    assert per_class < 4000 or sum(held) >= 0.95 * len(held)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (4, 7)], "doc_id long, label int")
    assert toxicity.toxicity(frame(spark, []), labels).count() == 0
    rows = corpus()
    found = toxicity.toxicity(frame(spark, rows), labels).collect()
    assert ordered([r.doc_id for r in found]) == ordered([i for i, _ in rows])
    assert {r.score for r in found if r.doc_id in (60, 61, 62)} == {0.5}
    none = toxicity.toxicity(frame(spark, rows), labels.where("false")).collect()
    assert {r.score for r in none} == {0.0}


def test_toxicity_query_learns_from_its_part_and_finds_the_rest(spark, small):
    found = QUERIES["op10_toxicity"](spark, small.replace("0.001", "0.01")).collect()
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small.replace('0.001', '0.01')}/labels.parquet").collect()}
    held = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and labels.get(r.doc_id) is not None]
    right = collections.Counter(held)
    assert right[0, 1] <= 0.05 * (right[0, 0] + right[0, 1])
    assert right[1, 1] >= 0.6 * (right[1, 0] + right[1, 1])


# --- urls ---

URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.com", "https://Example.com/en/1", "https://www.example.com/en/1?x",
    "https://a.www.example.com/en/", "https://example.com/EN/1", "ftp://shop.net/es/2#f", "http://shop.net/de/2", "x://y.net/fr",
    "http://badexample.com/en/1", "http://h.org/a/b/c/d/e/f/g", "http://h.org//a", "http://ÄB.org/é?://q", "http://u@shop.net:80/es/1",
    "a://b://c.com/en/", "http://line\nbreak.net/es/1",
]


def url_brute(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def test_urls_and_rules(spark):
    extra = {name: None for name in EXTRA.split()}
    data = [(i, url, *extra.values(), "x") for i, url in enumerate(URLS)]
    schema = "page_id long, url string" + "".join(f", `{name}` string" for name in extra) + ", host string"
    found = url_filter.judge_urls(spark.createDataFrame(data, schema), URL_RULES).collect()
    assert len(found) == len(URLS)
    for row in found:
        host, path = url_brute(URLS[row.page_id])
        fits = [
            (len(h + p), h + p, verdict)
            for verdict, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        rule, verdict = max(fits)[1:] if fits else (None, "allow")
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict), URLS[row.page_id]
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def test_templates_reject_what_resembles_blocked_urls(spark):
    rules = [("block", "h.org", "/ads/1"), ("allow", "h.org", "/news/")]
    urls = [f"http://h.org/ads/{1000 + i}/x" for i in range(900)] + [f"http://h.org/ads/{2000 + i}/x" for i in range(100)]
    urls += [f"http://h.org/news/{i}" for i in range(500)] + [f"http://h.org/other/{i}" for i in range(50)] + ["http://h.org/ads/1000/x"] * 3
    frame_of = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r for r in url_filter.judge_urls(frame_of, rules).collect()}
    assert len(found) == len(urls)
    assert {found[i].verdict for i in range(900, 1000)} == {"block"}  # no rule, but the template is a blocked one
    assert {found[i].template for i in range(1000)} == {"/ads/#any/x"}
    assert {found[i].verdict for i in range(1500, 1550)} == {"allow"}


def judged(spark, urls):
    return url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), URL_RULES).collect()


@pytest.mark.parametrize("many, few", [(995, 5), (60, 40), (15, 5), (3, 1)])
def test_clean_pages_beside_blocked_ones_stay(spark, many, few):
    found = judged(spark, [f"http://a.net/es/{i}" for i in range(many)] + [f"http://a.net/de/{i}" for i in range(few)])
    assert [r.verdict for r in sorted(found)] == ["block"] * many + ["allow"] * few


def test_similar_branches_merge_and_others_do_not(spark):
    urls = [f"http://a.net/{s}/{i}" for s in ("es", "fr", "de", "en") for i in range(30)] + ["http://a.net/it"]
    found = judged(spark, urls)
    templates = {r.path.split("/")[1]: (r.template, r.verdict) for r in found}
    assert {s: t for s, (t, _) in templates.items()} == {
        "es": "/es#2/#rest", "fr": "/es#2/#rest", "de": "/de/#rest", "en": "/en/#rest", "it": "/#unlabelled",
    }
    assert {s for s, (_, verdict) in templates.items() if verdict == "block"} == {"es", "fr"}


def test_templates_tell_deep_segments_apart(spark):
    rules = [("block", "h.org", "/a/b/c/d/e/f/bad/"), ("allow", "h.org", "/a/b/c/d/e/f/good/")]
    urls = [f"http://h.org/a/b/c/d/e/f/{s}/{i}" for s in ("bad", "good", "new") for i in range(40)]
    urls += [f"http://h.org/a/b/c/d/e/f/{s}" for s in ("bad", "good")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r for r in url_filter.judge_urls(pages, rules).collect()}
    assert {found[i].verdict for i in range(40)} == {"block"}
    assert {found[i].verdict for i in range(40, 122)} == {"allow"}
    assert len({found[i].template for i in (0, 40, 80)}) == 3


# --- neighbours ---


def nearest_brute(rows, k, step):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = [float(np.float32(x)) for x in v]
    out = []
    for q in good:
        if q % step == 0:
            scores = [
                (-math.fsum(a * b for a, b in zip(good[q], v, strict=True)), i)
                for i, v in good.items()
                if i != q and len(v) == len(good[q])
            ]
            out += [(q, rank, i) for rank, (_, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def test_nearest_equals_brute_force_where_all_are_verified(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 1.0, -0.5, 2.0]) for _ in range(6)]) for i in range(70)]
    rows += [(100, None), (120, [0.0] * 6), (140, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (160, [math.nan] * 6), (180, [math.inf] + [0.0] * 5)]
    rows += [(200, []), (None, [1.0] * 6), (220, [1.0, 2.0]), (240, [0.5, 1.0]), (40, rows[40][1]), (260, rows[40][1])]
    schema = "vec_id long, embedding array<float>, label string, vector string, block string, norm string"
    data = spark.createDataFrame([(i, v, None, None, None, None) for i, v in rows], schema).repartition(3)
    found = neighbours.nearest(data, F.col("vec_id") % 20 == 0, k=5, block_rows=16, query_rows=2).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == sorted(nearest_brute(rows, 5, 20))
    assert neighbours.nearest(data.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_collisions_are_counted_in_windows():
    rng = np.random.default_rng(0)
    rows = rng.standard_normal((600, 16))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    index = neighbours.CollisionIndex(rows, np.ones(600), 1.0, 24, 1)
    queries = rows[:20] + 0.05
    lines = index.lines
    projected = np.column_stack([rows, np.zeros(600)]) @ lines
    widths = neighbours.FIRST_WIDTH * neighbours.GROWTH ** np.arange(neighbours.LEVELS)
    found_of = dict(index.verified(queries, 15, 30))
    assert sorted(found_of) == list(range(20))
    for number, query in enumerate(queries):
        found = found_of[number]
        at = np.append(query / np.linalg.norm(query), 0) @ lines
        near = [np.flatnonzero((np.abs(projected - at) <= w).sum(axis=1) >= 15) for w in widths]
        assert any(np.array_equal(found, x) for x in near if len(x) >= 30)


def test_nearest_query_recalls(spark, small):
    sf_dir = small.replace("0.001", "0.1")
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").toPandas().sort_values("vec_id")
    ids, rows = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_list()).astype(float)
    found = QUERIES["op8_nearest"](spark, sf_dir).toPandas()
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = rows @ rows[q]
        scores[q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        own = found[found.query_id == ids[q]].sort_values("rank")
        hits += len(set(best) & set(own.vec_id))
        at = np.searchsorted(ids, own.vec_id)
        assert np.allclose(own.score, scores[at], atol=1e-12) and (np.diff(own.score) <= 1e-12).all()
        assert own["rank"].tolist() == list(range(1, 21))
    assert hits >= 0.9 * len(found) and len(found) == 20 * (ids % 20 == 0).sum()


@pytest.mark.parametrize("norms", ["equal", "one of 2", "one of 3", "one of 5", "lognormal", "narrow", "wide"])
def test_nearest_recalls_in_a_full_block_whatever_the_norms(norms):
    rng = np.random.default_rng(5)
    n, k = neighbours.BLOCK_ROWS, 20
    rows = rng.standard_normal((n, 64))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    asking = rows[:100].copy()
    if norms.startswith("one"):
        rows[-1] *= float(norms[-1])
    elif norms != "equal":
        rows *= np.exp(rng.standard_normal(n) * {"lognormal": 0.5, "narrow": 0.03, "wide": 2.0}[norms])[:, None]
    ids = rng.permutation(n)
    found = neighbours.best_of_block(ids, rows, np.linalg.norm(rows, axis=1), ids[:100], asking, k)
    hits = 0
    for q, (own, scores) in enumerate(found):
        exact = rows @ asking[q]
        exact[q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -exact))[:k]]) & set(own.tolist()))
        assert len(own) == k and (np.diff(scores) <= 0).all()
    print(norms, hits / (100 * k))
    assert hits >= 0.9 * 100 * k
