"""Prefix trie, filter audit and secret scans against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from headway.llm import filter_audit, prefix_trie, secrets
from headway.llm.queries import on_workers, op11_prefix_trie, op13_secrets

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    on_workers(lambda session, folder: None)(spark, "")


# --- Prefix trie


def brute_trie(rows):
    """All nodes of the trie, from (conv_id, turn, role, text) without equal turns in a conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    members = defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        head = conv - (abs(conv) % 5) * (1 if conv >= 0 else -1)
        whole = own.get(head, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((conv, len(whole) == d))
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, found = {}, {}, set()
    for path in sorted(members, key=len, reverse=True):
        ids = sorted(conv for conv, _ in members[path])
        own_saved = (len(ids) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own_saved + sum(saved[c] for c in children[path])
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        ends = ",".join(str(conv) for conv in sorted(conv for conv, ended in members[path] if ended))
        parent = min(conv for conv, _ in members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.add((ids[0], len(path), parent, len(ids), len(children[path]), leaves[path], saved[path], digest))
    return found


def same_trie(spark, data, width=prefix_trie.WIDTH):
    frame = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    got = [tuple(r) for r in prefix_trie.prefix_trie(frame.repartition(3), width).select(*prefix_trie.RESULT).collect()]
    expected = brute_trie(data)
    assert len(got) == len(expected)
    assert set(got) == expected


def conversations(seed, convs, longest, words):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-convs, 3 * convs), convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn or rng.choice([None, 0]), rng.choice(["user", None]), rng.choice([*words, None, ""])))
    return rows


def test_trie_of_the_table(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in op11_prefix_trie(spark, SF_DIR).select(*prefix_trie.RESULT).collect()} == brute_trie(data)


@pytest.mark.parametrize(("width", "shard"), [(32, 1 << 15), (2, 7), (3, 5), (1, 3)])
def test_trie_of_narrow_segments_and_many_shards(spark, monkeypatch, width, shard):
    monkeypatch.setattr(prefix_trie, "ROWS_PER_SHARD", shard)
    monkeypatch.setattr(prefix_trie, "TURNS_PER_PART", 11)
    same_trie(spark, conversations(width, 40, 13, ["a", "é"]), width)


def test_trie_with_hot_conversations(spark, monkeypatch):
    """One conversation with a third of the turns, and a third of the conversations alike."""
    monkeypatch.setattr(prefix_trie, "ROWS_PER_SHARD", 9)
    monkeypatch.setattr(prefix_trie, "TURNS_PER_PART", 20)
    monkeypatch.setattr(prefix_trie, "IDS_PER_CHUNK", 2)
    data = [(5, i, "user", f"t{i % 7}") for i in range(70)] + [(1005, i, "user", f"t{i % 7}") for i in range(66)]
    data += [(10 * i, turn, "user", "same") for i in range(30, 70) for turn in range(2)]
    same_trie(spark, data, 8)


def test_trie_of_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (7, None, None, None), (7, 1, "", ""), (8, 0, "us", "era"), (10**15, 0, "user", "a" * 100_000)]
    same_trie(spark, rows)
    schema = "conv_id bigint, turn bigint, role string, text string, level string, ids int, path int"
    clashing = spark.createDataFrame([(*row, "l", 1, 2) for row in rows], schema)
    assert {tuple(r) for r in prefix_trie.prefix_trie(clashing).select(*prefix_trie.RESULT).collect()} == brute_trie(rows)
    assert prefix_trie.prefix_trie(clashing.limit(0)).count() == 0
    # Equal turns are ordered by their content, whatever the order of the rows; repeated rows are turns each.
    tied = [(20, 3, "user", text) for text in "abcab"]
    first, second = (
        {tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(x, "conv_id bigint, turn bigint, role string, text string")).collect()}
        for x in (tied, tied[::-1])
    )
    assert first == second and max(r[1] for r in first) == 5


# --- Filter audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute_audit(docs, labels):
    """{(part, order, step): counts} from (doc_id, text, lang) and {doc_id: (quality, toxic)}."""
    first = {}
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    failing = []
    for doc, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        tests = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and first[text] < doc,
        }
        failing.append((lang or "", {name for name, failed in tests.items() if failed}, *labels.get(doc, (0, 0))))
    shapley, told = Counter(), {}
    for part in {lang for lang, *_ in failing}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [x for x in failing if x[0] == part]
            for step, name in enumerate(order, 1):
                here = [x for x in left if name in x[1]]
                all_failing = [x for x in failing if x[0] == part and name in x[1]]
                left = [x for x in left if name not in x[1]]
                alone = sum(x[1] == {name} for x in all_failing)
                good, toxic = sum(x[2] == 1 for x in here), sum(x[3] == 1 for x in here)
                told[part, order, step] = (len(left), len(here), len(all_failing) - len(here), alone, good, toxic)
                shapley[part, name] += len(here)
    return {key: (*counts, shapley[key[0], key[1][key[2] - 1]]) for key, counts in told.items()}


def audited(docs, labels):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[name] for name in COUNTS) for r in filter_audit.audit(docs, labels).collect()}


def test_audit_equals_brute_force(spark):
    rng = random.Random(12)
    pool = ["word", "Word", "é", "日本", "A", "#", "B*", "\x1c", "a\x85b", "x" * 130, "x" * 131, *(f"w{i}" for i in range(120))]
    texts = [None, "", " \n", "A" * 50_000, "ab " * 20_000]
    texts += [" ".join(rng.choices(pool[rng.randint(0, 11) :], k=rng.choice([5, 99, 100, 130, 400]))) for _ in range(60)]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    docs += [(3, docs[3][1], "en")] * 3 + [(None, texts[9], "en"), (None, texts[9], "en")]
    labels = {i: (rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 150, 2)}
    frame = spark.createDataFrame([(*d, 0, "p") for d in docs], "doc_id bigint, text string, lang string, n int, part string").repartition(4)
    known = [(i, *both, "x") for i, both in labels.items()] + [(3, 0, None, "x"), (None, 1, 1, "x")]
    marks = spark.createDataFrame(known, "doc_id bigint, quality int, toxic int, lang string")
    assert audited(frame, marks) == brute_audit(docs, labels)
    assert audited(frame.limit(0), marks) == {}
    assert audited(frame, marks.limit(0)) == brute_audit(docs, {})


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(filter_audit, "_hashes", lambda padded, starts, lengths, owners: np.zeros(len(starts), np.uint64))
    texts = [b"abcdefgh1 abcdefgh2 abcdefgh1", b"", b"abcdefgh1 \n a", b"a a a b"]
    offsets = np.cumsum([0, *map(len, texts)])
    assert filter_audit.scan(np.frombuffer(b"".join(texts), np.uint8), offsets)["distinct"].tolist() == [2, 0, 2, 2]


# --- Secret scans

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
PLAIN = (
    ("assign", ASSIGN, lambda m: len(m.group(1)) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 24),
)


def brute_secrets(text):
    found = [(m.start(), i, m.end(), kind) for i, (kind, pattern, keep) in enumerate(PLAIN) for m in pattern.finditer(text or "") if keep(m)]
    return sorted(found)


def spans(found):
    return [(s["start"], s["number"], s["end"], s["kind"]) for s in found if s["number"] < secrets.N_BASE]


ID, KEY = "AKIA" + "ABCDEFGH23456789", "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEYaa"


def test_plain_secrets_equal_brute_force(spark):
    rng = random.Random(13)
    pieces = ["password", "PassWd", "token", "api_key", "apikey", "secret", "=", ":", " ", "  ", '"', "'", "\n", "abc", "0123456789abcdef", "é日😀"]
    pieces += ["AKIA", "ABCDEFGH23456789", "Z", "ſecret=abcdefgh", "beef" * 6, "\n\n", KEY, "user=joe"]
    texts = [None, "", "secret=token: abcdefgh", "x" * 100_000 + ID, f"{ID} " * 3000, "0" * 200_000, "token=" * 5000]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(300)]
    frame = spark.createDataFrame([(i // 2, t, 1, "r") for i, t in enumerate(texts)], "doc_id bigint, text string, kind int, row string")
    got = Counter((r["doc_id"], tuple(spans(r["secrets"]))) for r in secrets.find_secrets(frame.repartition(3)).collect())
    assert got == Counter((i // 2, tuple(brute_secrets(t))) for i, t in enumerate(texts))
    assert secrets.find_secrets(frame.limit(0)).count() == 0


def weak(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: r["secrets"] for r in secrets.find_secrets(frame).collect()}
    return [[(s["kind"], t[s["start"] : s["end"]]) for s in found[i] if s["number"] >= secrets.N_BASE] for i, t in enumerate(texts)]


def test_weak_candidates_need_the_other_parts(spark):
    end = "https://s3.example.com:443"
    far = " x" * (secrets.REACH // 2)
    found = weak(
        spark,
        f"é {KEY} alone",
        f"{ID} and {KEY}",
        f"{KEY}{far[:-3]} {ID}",
        f"{KEY}{far} {ID}",
        f"{KEY}\n \n{ID}",
        f"{KEY}\n{ID}",
        f"user = joe, {end}",
        f"user = joe, password: hunter22, {end}",
        f"😀 {end} {ID}",
        f"login: joe {KEY}",
        f"{ID} secret = {KEY} {end}",
        f"{ID} {KEY}a {KEY[:-1]} {KEY[:-1]}=",
    )
    key, login, endpoint = ("key", KEY), ("login", "user = joe"), ("endpoint", end)
    assert found == [
        [], [key], [key], [], [], [key], [], [login, endpoint], [], [("login", "login: joe"), key], [endpoint], [],
    ]


def test_secret_digest_of_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op13_secrets(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = brute_secrets(texts[row["doc_id"]])
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in expected)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind, *_ in PLAIN] == [sum(x[3] == kind for x in expected) for kind, *_ in PLAIN]
        assert set(joined.split(",")) - {""} <= set(row["spans"].split(","))


def test_secret_scan_runs_in_the_engine_alone(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    plan = secrets.digest_columns(secrets.find_secrets(frame))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
