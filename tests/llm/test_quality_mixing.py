"""Quality rules, mixing, the two classifiers and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from headway.llm import bpe, mixing, pii, quality_rules, simhash, toxicity, weak_labels
from headway.llm.queries import llm_oracles, llm_queries, on_workers, op7_weak_labels, op8_quality_rules, op10_toxicity

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    on_workers(lambda session, folder: None)(spark, "")


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


# --- Quality rules


def brute_rules(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 8))
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_rules_on_odd_texts(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t ", "a", "a " * 7, "a " * 8, "a " * 9, "x\x1cy\x85z é#|<>\u3000b", "l\nl\n\nl\r\nl", "w " * 50_000]
    texts += [" ".join(rng.choices("abc", k=rng.randint(1, 60))) + "\n" * (i % 3) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(1, "", "x")], "doc_id bigint, text string, words string")
    rows = quality_rules.judge(docs, docs.filter("doc_id > 20")).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        assert tuple(row[name] for name in RULES) == brute_rules(texts[row["doc_id"]])
        assert not (row["kept"] and row["base_failed"])
    assert quality_rules.judge(docs.limit(0), docs.limit(0)).count() == 0


def test_ratio_scores_equal_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, "documents").collect()}
    trusted = {r["doc_id"] for r in table(spark, "labels").filter("quality = 1").collect()}
    numbers = {}
    for row in quality_rules.hashed_words(table(spark, "documents")).select("doc_id", "words", "h1", "h2").collect():
        grams = [h & (quality_rules.BUCKETS - 1) for h in [*row["h1"], *row["h2"][:-1]]]
        assert len(grams) == max(2 * len(WORD.findall(docs[row["doc_id"]])) - 1, 0)
        numbers[row["doc_id"]] = grams
    raw, good = Counter(), Counter()
    for doc, grams in numbers.items():
        raw.update(grams)
        good.update(grams if doc in trusted else ())
    sizes = sum(raw.values()) + quality_rules.BUCKETS, sum(good.values()) + quality_rules.BUCKETS
    ratio = {b: round(1_000_000 * (math.log((good[b] + 1) / (raw[b] + 1)) + math.log(sizes[0] / sizes[1]))) for b in raw}
    for row in op8_quality_rules(spark, SF_DIR).collect():
        grams = numbers[row["doc_id"]]
        assert tuple(row[name] for name in RULES) == brute_rules(docs[row["doc_id"]])
        assert row["kept"] == (not row["base_failed"] and sum(map(ratio.get, grams)) >= round(-0.1 * 1_000_000) * len(grams))


def test_no_python_in_quality_rules(spark):
    docs = table(spark, "documents")
    plans = quality_rules.rule_columns(docs, [0] * quality_rules.BUCKETS), quality_rules.bucket_counts(docs, docs)
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "from_json" not in text


# --- Mixing


@pytest.mark.parametrize("mean", [0, 0.01, 0.3, 1, 4.5, 60, 2000, 1e8])
def test_poisson_thresholds(mean):
    certain, thresholds = mixing.poisson_thresholds(mean)
    assert len(thresholds) < 30 * math.sqrt(mean) + 100
    assert thresholds == sorted(thresholds) and thresholds[-1] == mixing.RANGE
    expected = certain + sum(1 - t / mixing.RANGE for t in thresholds)
    assert expected == pytest.approx(mean, rel=1e-6, abs=1e-9)


def test_mixing_repeats_a_tiny_source_often(spark):
    docs = spark.createDataFrame([(1, "tiny", "ab"), (2, "large", "x" * 4000)], "doc_id bigint, source string, text string")
    counts = Counter(row["source"] for row in mixing.mix(docs, {"tiny": 0.5}).collect())
    assert counts["tiny"] == pytest.approx(1000.5, abs=5 * math.sqrt(1000.5))


def test_mixing_keeps_columns_with_its_names(spark):
    docs = spark.createDataFrame(
        [(i, "s", "text", i, f"k{i}", "Z") for i in range(50)],
        "doc_id bigint, source string, text string, copy bigint, mix_key string, _copy string",
    )
    rows = mixing.mix(docs, {}, extra=True).collect()
    assert mixing.mix(docs, {}).columns == docs.columns
    assert rows and all((r["copy"], r["mix_key"], r["_copy"]) == (r["doc_id"], f"k{r['doc_id']}", "Z") for r in rows)
    assert [r["mix_key_"] for r in rows] == sorted(r["mix_key_"] for r in rows) and all(r["copy_"] >= 1 for r in rows)


def test_mixing_reaches_its_shares(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}", "some text", "k") for i in range(6000)] + [(None, None, None, "k"), (1, "s1", "", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, copy string")
    mixed = mixing.mix(docs, {"hot": 0.5, "s1": 0.2})
    assert mixed.columns == docs.columns
    sizes = Counter()
    for row in mixed.collect():
        sizes[row["source"]] += len(row["text"] or "")
    total = sum(sizes.values())
    assert sizes["hot"] / total == pytest.approx(0.5, abs=0.03) and sizes["s1"] / total == pytest.approx(0.2, abs=0.03)
    first, again = (mixing.mix(docs.repartition(n).select("doc_id", "source", "text"), {"hot": 0.5}, extra=True).collect() for n in (2, 5))
    assert [tuple(r) for r in first] == [tuple(r) for r in again]
    assert mixing.mix(docs.limit(0), {"hot": 0.5}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"hot": 0.7, "s1": 0.4})


# --- Weak labels


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(0)
    right = np.array([0.95, 0.9, 0.9, 0.85, 0.8, 0.8, 0.7, 0.6])
    good = rng.random(20_000) < 0.8
    agrees = rng.random((20_000, 8)) < right
    votes = np.where(agrees == good[:, None], "g", "b")
    votes[rng.random(votes.shape) < 0.1] = "-"
    posterior, tables = weak_labels.estimate(Counter(map("".join, votes)))
    found = np.array([posterior["".join(v)] >= 0.5 for v in votes])
    assert (found == good).mean() > 0.97
    assert tables[1, :, 0] / (1 - tables[1, :, 2]) == pytest.approx(right, abs=0.03)


def plain_posteriors(counts):
    """EM by loops over patterns, heuristics and votes."""
    good = {p: 1 / (1 + math.exp(2 * p.count("b") - p.count("g"))) for p in counts}
    while True:
        mass = {k: sum(n * (good[p] if k else 1 - good[p]) for p, n in counts.items()) for k in (0, 1)}
        tables = {}
        for k in (0, 1):
            for i in range(len(weak_labels.LIMITS)):
                hits = {v: 1 + sum(n * (good[p] if k else 1 - good[p]) for p, n in counts.items() if p[i] == v) for v in "gb-"}
                for v, hit in hits.items():
                    tables[k, i, v] = hit / sum(hits.values())
        after = {}
        for p in counts:
            odds = {k: math.log((mass[k] + 1) / (sum(mass.values()) + 2)) + sum(math.log(tables[k, i, v]) for i, v in enumerate(p)) for k in (0, 1)}
            after[p] = 1 / (1 + math.exp(min(max(odds[0] - odds[1], -500), 500)))
        if max(abs(after[p] - good[p]) for p in counts) <= weak_labels.TOLERANCE:
            return after
        good = after


def plain_features(text):
    """Shares of word shapes, endings and repetitions, word by word."""
    import xxhash

    bucket = lambda name: xxhash.xxh64_intdigest(name) % weak_labels.SPACE
    words, counts, before, seen = (text or "").split(), Counter(), None, set()
    for word in words:
        kinds = []
        for c in word:
            kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
            if not kinds or kinds[-1] != kind:
                kinds.append(kind)
        shape = "".join(kinds[:12])
        counts.update([bucket("shape " + shape), bucket("end " + shape[-2:])])
        counts.update([bucket("=before")] * (word == before) + [bucket("=seen")] * (word in seen))
        before = word
        seen.add(word)
    return {b: math.sqrt(n / len(words)) for b, n in counts.items()}


def test_weak_labels_equal_brute_force(spark):
    docs = table(spark, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = {r["doc_id"]: r for r in op7_weak_labels(spark, SF_DIR).collect()}
    counts = Counter(weak_labels.votes(text) for text in texts.values())
    posterior = plain_posteriors(counts)
    weights, bias = weak_labels.train(weak_labels.with_features(docs), weak_labels.estimate(counts)[0])
    for doc, text in texts.items():
        assert rows[doc]["votes"] == weak_labels.votes(text)
        assert rows[doc]["posterior"] == pytest.approx(posterior[rows[doc]["votes"]], abs=1e-6)
        margin = bias + sum(weights[b] * v for b, v in plain_features(text).items())
        assert rows[doc]["score"] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-5)


def test_shapes_read_whole_words():
    assert weak_labels.shape("a" * 48 + "123") == weak_labels.shape("a" * 47 + "123") == "a0"
    assert weak_labels.shape("Ab1-" * 9) == "Aa0-Aa0-Aa0-" and weak_labels.shape("") == ""


def test_weak_labels_against_quality_labels(spark):
    truth = {r["doc_id"]: r["quality"] for r in table(spark, "labels").collect()}
    rows = op7_weak_labels(spark, SF_DIR).collect()
    judged = [(row["kept"], truth[row["doc_id"]]) for row in rows if row["doc_id"] in truth]
    assert len(rows) == table(spark, "documents").count()
    assert sum(kept == bool(quality) for kept, quality in judged) / len(judged) > 0.9


def test_weak_labels_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (None, "", 2.0), (2, "word " * 100_000, 3.0), (2, "ok text here", 4.0)], "doc_id bigint, text string, score double")
    rows = weak_labels.judge(docs).collect()
    assert len(rows) == 4 and all(0 <= row["score"] <= 1 for row in rows)
    assert weak_labels.judge(docs.limit(0)).count() == 0


# --- Toxicity


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = {row["doc_id"]: row for row in op10_toxicity(spark, sf).collect()}
    for doc, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2) and row["predicted"] == int(row["score"] >= 0.3)
    judged = [(rows[r["doc_id"]]["score"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]]
    clean, toxic = ([s for s, t in judged if t == kind] for kind in (0, 1))
    ranked = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert ranked > 0.85
    assert sum(s >= 0.3 for s in clean) / len(clean) < 0.1


def biased_corpus(spark):
    rng = random.Random(6)
    filler = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(1200):
        toxic = i % 4 == 0
        words = rng.choices(filler, k=20) + (["idiot"] if toxic and rng.random() < 0.8 else [])
        words += ["muslims"] if rng.random() < (0.7 if toxic else 0.05) else []
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "toxic")


def test_counterfactuals_reduce_identity_bias(spark):
    docs, labels = biased_corpus(spark)
    plain, fair = (toxicity.train(docs, labels, counterfactual=c) for c in (0.0, 20.0))
    neutral = "w1 w2 muslims w3 w4 w5"
    assert fair.score(neutral) < plain.score(neutral) / 2
    assert fair.score("w1 idiot w2") > 0.3
    assert fair.score(neutral) - fair.score(neutral.replace("muslims", "christians")) < 0.05


def test_every_term_of_a_group_is_tried():
    others = toxicity.counterfactuals("The African Americans, and old people!".split())
    assert len(others) == 7 <= toxicity.SWAPS
    assert others[0][1:3] == ["asian", "americans"] and others[0][-2:] == ["young", "people"]
    assert all(not set.intersection(*(set(term.split()) for term in group)) for group in toxicity.IDENTITY_GROUPS)
    for group in toxicity.IDENTITY_GROUPS:
        for term in group:
            found = {" ".join(x) for x in toxicity.counterfactuals(term.split())}
            assert found == set(group) - {term}
    assert toxicity.counterfactuals("people of america".split()) == []
    # Terms of one group stay apart, and each counterfactual has as many of them.
    assert all(x[0] != x[2] for x in toxicity.counterfactuals(["women", "and", "men"]))


MENTIONED = ("muslims", "african americans", "old people", "frauen", "musulmanes")


def test_neutral_mentions_of_every_group_are_left_alone(spark):
    """In toxic texts, one term of each group is overrepresented; on held-out neutral texts that name any term of the group
    the penalty brings false positives down, and keeps toxic texts found."""
    rng = random.Random(10)
    filler = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(2400):
        toxic = i % 4 == 0
        words = rng.choices(filler, k=14) + (["idiot"] if toxic and rng.random() < 0.85 else [])
        words += [rng.choice(MENTIONED)] if rng.random() < (0.8 if toxic else 0.04) else []
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    plain, fair = (toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), counterfactual=c) for c in (0.0, 20.0))
    neutral = lambda term: " ".join([*rng.choices(filler, k=7), term, *rng.choices(filler, k=7)])
    for mention in MENTIONED:
        group = next(g for g in toxicity.IDENTITY_GROUPS if mention in g)
        texts = [neutral(mention) for _ in range(60)]
        rate = [sum(model.score(x) >= toxicity.THRESHOLD for x in texts) / len(texts) for model in (plain, fair)]
        assert rate[0] > 0.2 and rate[1] < 0.2 * rate[0], (mention, rate)
        scores = [fair.score(f"w1 w2 {term} w3 w4") for term in group]
        assert max(scores) - min(scores) < 0.1, mention
    assert sum(fair.score(neutral("idiot")) >= toxicity.THRESHOLD for _ in range(60)) > 50


def test_scores_equal_plain_sums(spark):
    """Scores from the model's weights by plain loops over words and their beginnings."""
    import xxhash

    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = toxicity.train(docs, labels)
    rows = {r["doc_id"]: r["score"] for r in toxicity.judged(docs, labels).collect()}
    for row in docs.collect():
        counts = Counter()
        for word in (row["text"] or "").split():
            word = word.lower().strip(toxicity.STRIPPED)
            for part in [word, *("^" + word[:n] for n in range(3, 7) if n <= len(word))] if word else []:
                counts[xxhash.xxh64_intdigest(part) % toxicity.SPACE] += 1
        margin = model.bias + sum(model.weights.get(b, 0.0) * math.log1p(n) for b, n in counts.items())
        assert rows[row["doc_id"]] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_toxicity_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (3, "x " * 100_000, "c"), (3, "x", "d")], "doc_id bigint, text string, toxicity string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (9, None), (3, 1)], "doc_id bigint, toxic int")
    rows = toxicity.judged(docs, labels).collect()
    assert len(rows) == 4 and all(0 <= row["score"] <= 1 for row in rows)
    kept = toxicity.drop_toxic(docs, labels.limit(0))
    assert kept.schema == docs.schema and kept.count() == 4
    assert toxicity.judged(docs.limit(0), labels).count() == 0


# --- Pipeline


def test_stages_follow_one_another(spark):
    docs = table(spark, "documents")
    read = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "encoding":
            assert out.columns == docs.columns
            out = corpus_pipeline.stored(out, "test-stage")
        read.append((docs.collect(), out.collect()))
        docs = out
    toxic, near, private, mixed, encoded = read
    scores = toxicity.train(table(spark, "documents"), table(spark, "labels"))
    assert sorted(r["doc_id"] for r in toxic[1]) == sorted(r["doc_id"] for r in toxic[0] if scores.score(r["text"]) < 0.3)
    values = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in near[0]}
    kept = [values[r["doc_id"]] for r in near[1]]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(kept) for b in kept[i + 1 :])
    assert sorted((r["doc_id"], pii.redact(r["text"])) for r in private[0]) == sorted((r["doc_id"], r["text"]) for r in private[1])
    assert {r["doc_id"] for r in mixed[1]} <= {r["doc_id"] for r in mixed[0]}
    vocabulary = bpe.vocabulary(corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY))
    texts = {r["doc_id"]: r["text"] for r in encoded[0]}
    assert len(encoded[0]) == len(encoded[1])
    for row in encoded[1]:
        assert vocabulary.decode(np.array(row["token_ids"], "<u4").tobytes()) == texts[row["doc_id"]]
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").collect()) == sorted(r["doc_id"] for r in encoded[1])


def test_registration():
    assert [name.split("_")[0] for name in llm_queries()] == [f"op{n}" for n in range(1, 14)]
    assert set(llm_oracles()) <= set(llm_queries()) and corpus_pipeline.ORACLE_SQL is None
