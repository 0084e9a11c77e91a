"""Personal data and BPE: against regular expressions, the tokenizers library and exact round trips."""

import re

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import bpe, pii
from headway.llm.queries import VOCABULARY, on_workers, op1_pii, op6_bpe

PATH = public_tokenizers.path(VOCABULARY)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    on_workers(lambda session, folder: None)(spark, "")


# --- Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for found in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", found.group())
            fits = {
                "email": True,
                "ip": kind != "ip" or all(int(part) <= 255 for part in found.group().split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                spans.append(pii.Span(kind, found.start(), found.end()))
    return pii.ordered(spans)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.b-%1+2( )", max_size=40) | st.text(alphabet="0123456789.- +", max_size=60))
def test_plain_spans_equal_patterns(text):
    assert pii.plain_spans(text) == brute_spans(text)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write to jоhn[at]example[dot]com now", "email", "jоhn[at]example[dot]com"),
        ("mary dot poe at mail dot example dot org", "email", "mary dot poe at mail dot example dot org"),
        ("ann&#64;example&#46;com", "email", "ann&#64;example&#46;com"),
        ("host one nine two dot one six eight dot one dot one up", "ip", "one nine two dot one six eight dot one dot one"),
        ("call plus one two three four five six seven eight nine zero", "phone", "plus one two three four five six seven eight nine zero"),
        ("card ４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("to ann&COMMAT;example.com", "email", "ann&COMMAT;example.com"),
        ("john AT example dOt com", "email", "john AT example dOt com"),
        ("eve" + " " * 9 + "(at)" + " " * 90 + "example.com", "email", "eve" + " " * 9 + "(at)" + " " * 90 + "example.com"),
        ("mary     dot     poe at example dot org", "email", "mary     dot     poe at example dot org"),
        ("a" * 90 + " dot b at example dot org", "email", "a" * 90 + " dot b at example dot org"),
        (",".join(["four", *["one"] * 15]), "card", ",".join(["four", *["one"] * 15])),
        ("-".join(["FOUR", *["One"] * 15]), "card", "-".join(["FOUR", *["One"] * 15])),
        ("x [[(at)]] y {{dot}} com", "email", "x [[(at)]] y {{dot}} com"),
        ("zero​width 4111​1111​1111​1111", "card", "4111​1111​1111​1111"),
    ],
)
def test_disguised_spans_map_back(text, kind, found):
    plain, spans = pii.find(text)
    added = [span for span in spans if span not in plain]
    assert [(span.kind, text[span.start : span.end]) for span in added] == [(kind, found)]


PIECES = ["at", "AT", "dot", "Dot", "d0t", "(at)", "[dot]", "&commat;", "%40", "a.b", "ann", "-", ",", " ", "  ", "\t", "\n", "[", ")", "<", ".", "one",
          "Six", "zéro", "ſix", "sıx", "plus", "point", "7", "41", "_", "é", "о", "\u200b", "@", "com"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join) | st.lists(st.sampled_from(PIECES), max_size=40).map(" ".join))
def test_prefilters_reject_nothing_that_is_found(text):
    found = pii.find(text)
    with pytest.MonkeyPatch.context() as off:
        off.setattr(pii, "may_spell_digits", lambda text: True)
        off.setattr(pii, "_MAY_BRACKET", re.compile(""))
        off.setattr(pii, "_MAY_SPEAK", re.compile(""))
        assert pii.find(text) == found
    assert found[0] == brute_spans(text) and set(found[0]) <= set(found[1])


N = 1 << 20


@pytest.mark.parametrize(
    "text",
    [
        "(at) " + "[" * N,
        "a@b.cd x (at) y.zz " * (N // 19),
        "[ " * (N // 2),
        "(at)" * (N // 4),
        "x" + " " * N + "(at)",
        "at" + " " * N,
        " at" * (N // 3),
        "a dot " * (N // 6) + "b at c dot de",
        "a at b dot cd " * (N // 14),
        "one " * (N // 4),
        "one, " * (N // 5) + " " * N,
        "1" * N,
        "+1" * (N // 2),
        "1." * (N // 2),
        "@a." * (N // 3),
    ],
    ids=lambda text: text[:12],
)
def test_long_texts_take_time_in_proportion(text):
    import time

    took = []
    for part in (text[: N // 4], text[:N]):
        began = time.process_time()
        pii.find(part)
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0] + 0.5


def test_ordinary_words_are_left_alone():
    for text in ("look at example.com", "meet at noon dot", "one or two", "un deux et la vie", "Привет мир", ""):
        assert pii.find(text) == ([], [])


def test_base_spans_stay_and_redaction_keeps_the_rest():
    text = "a@b.cd and x (at) y (dot) org; 1.2.3.4"
    plain, spans = pii.find(text)
    assert plain == brute_spans(text) and set(plain) <= set(spans) and len(spans) == 3
    assert pii.redact(text) == "[EMAIL] and [EMAIL]; [IP]"


def test_pii_on_tables(spark):
    schema = "doc_id bigint, text string, pii_spans string, n_chars bigint"
    docs = spark.createDataFrame([(1, None, "x", 5), (1, None, "x", 5), (2, "", None, 0), (None, "a@b.c " * 30_000, "y", None)], schema)
    found = pii.find_pii(docs).orderBy("n_chars").collect()
    assert sorted(len(row["pii_plain"]) for row in found) == [0, 0, 0, 30_000]
    other = docs.selectExpr("doc_id", "text", "CAST(n_chars AS STRING) AS n_chars")
    assert {row["n_chars"] for row in pii.redact_pii(other).collect()} == {"5", "0", None}
    redacted = pii.redact_pii(docs)
    assert redacted.schema == docs.schema
    rows = {row["n_chars"]: row for row in redacted.collect()}
    assert rows[5]["text"] is None and rows[0]["text"] == "" and rows[240_000]["text"] == "[EMAIL] " * 30_000
    assert pii.digest_columns(pii.find_pii(docs.limit(0))).count() == 0


def test_op1_equals_patterns(spark):
    docs = {row["doc_id"]: row["text"] or "" for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    import hashlib

    rows = op1_pii(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for row in rows:
        spans = brute_spans(docs[row["doc_id"]])
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(s.kind == kind for s in spans) for kind in pii.KINDS]
        assert row["base_sha256"] == hashlib.sha256(pii.joined(spans).encode()).hexdigest()
        assert set(pii.joined(spans).split(",")) <= set(row["spans"].split(","))


# --- BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def assert_same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    own = bpe.vocabulary(PATH).encode(text)
    assert np.frombuffer(own, "<u4").tolist() == ids
    assert bpe.vocabulary(PATH).decode(own) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text(alphabet="abe hT'srt \n<|endofx>", max_size=80))
def test_bpe_equals_library(text):
    assert_same(Tokenizer.from_file(PATH) if not hasattr(test_bpe_equals_library, "lib") else test_bpe_equals_library.lib, text)


test_bpe_equals_library.lib = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "a" * 5000, "é" * 999 + " \n\n x", "\x00\x1c\x85"])
def test_bpe_edge_cases(library, text):
    assert_same(library, text)


def test_segment_tree_equals_plain_merging():
    rng = np.random.default_rng(3)
    for _ in range(300):
        merges = {int(k): (rank, 6 + rank) for rank, k in enumerate(rng.permutation(36)[:12])}
        merges = {(k // 6) * 100 + k % 6: v for k, v in merges.items()}
        symbols = rng.integers(0, 6, rng.integers(0, 30)).tolist()
        plain = list(symbols)
        while True:
            ranked = [(merges[a * 100 + b], i) for i, (a, b) in enumerate(zip(plain, plain[1:])) if a * 100 + b in merges]
            if not ranked:
                break
            (_, new), at = min(ranked)
            plain[at : at + 2] = [new]
        assert bpe.merge_word(list(symbols), merges, 100) == plain


def test_bpe_on_tables(spark, library):
    docs = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (2, "", "t"), (3, "Hello world", None)], "doc_id bigint, text string, token_ids string")
    back = bpe.decode_ids(bpe.encode_texts(docs, PATH), PATH)
    rows = {row["doc_id"]: row for row in back.collect()}
    assert back.count() == 4 and rows[1]["token_ids"] == [] and rows[2]["decoded"] == "" and rows[3]["decoded"] == "Hello world"
    assert rows[3]["token_ids"] == library.encode("Hello world").ids
    assert bpe.digest_columns(docs.limit(0), PATH).count() == 0


def test_op6_equals_library(spark, library):
    import hashlib

    docs = {row["doc_id"]: row["text"] or "" for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in op6_bpe(spark, SF_DIR).collect():
        ids = library.encode(docs[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
