"""Operators 3, 5, 8 and 9."""

import base64
import gzip
import re
import tracemalloc
import urllib.parse
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tillmart.llm import pieces, quality_neighbours, secrets, toxicity
from tests.llm.cases import documents, frame, prose

FOLDER = "/root/testdata/sf0.01"


def accuracy(spark, result, label):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = result.join(labels, "doc_id").filter("held_out").collect()
    return sum(r["predicted"] == r[label] for r in rows) / len(rows)


def test_held_out_accuracy(spark):
    from tillmart.llm import queries

    assert accuracy(spark, queries.op3_toxicity(spark, FOLDER), "toxic") >= 0.95
    assert accuracy(spark, queries.op8_quality_neighbours(spark, FOLDER), "quality") >= 0.95


def labelled(spark):
    rows = []
    for i in range(80):
        bad = i % 4 == 0
        words = prose(i, 60).split()
        if bad:
            words[10:10] = ["scoundrel", "villain", "rascally"]
        rows.append((i, " ".join(words), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return docs.drop("toxic"), docs.selectExpr("doc_id", "toxic", "1 - toxic as quality")


def test_toxicity_finds_misspellings(spark):
    model = toxicity.train(*labelled(spark))
    assert {"scoundrel", "villain"} <= {t for t, _, _ in model.terms}
    texts = [(1, prose(900, 50) + " scoundrel villain"), (2, prose(901, 50) + " scuondrel! vilain rascally"), (3, prose(902, 50)), (4, None), (5, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert got[1]["score"] > 0.5 and got[1]["n_exact"] == 2
    assert got[2]["n_near"] == 2 and got[2]["score"] > got[3]["score"]
    assert got[3]["score"] < 0.5 and got[4]["score"] == got[5]["score"] < 0.5


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=12))
def test_automaton_equals_edit_distance(word):
    terms = ["abcab", "bbbb", "cabcabcab", "ccaacc"]
    matcher = toxicity.Matcher(toxicity.Model(terms=[(t, False, 1.0) for t in terms]))
    allowed = [(d, t) for t in terms if (d := edits(word, t)) <= (len(t) >= 5) + (len(t) >= 9)]
    verdict = matcher.verdict(word)
    assert (verdict[0] if verdict else None) == (min(allowed)[0] if allowed else None)


def test_quotation_is_told_from_abuse():
    matcher = toxicity.Matcher(toxicity.Model(terms=[("scoundrel", False, 1.0)]))
    quoted = matcher.features('the paper said "he is a scoundrel" today')
    abuse = matcher.features("you are a scoundrel and you know it")
    assert quoted[3] > 0 and quoted[4] == 0 and abuse[3] == 0 and abuse[4] > 0


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality_neighbours, "quality")])
def test_without_labels_or_rows(spark, module, label):
    docs = frame(spark)
    labels = spark.createDataFrame([], f"doc_id long, {label} int")
    model = module.train(docs, labels)
    rows = module.score(docs, model).collect()
    assert len(rows) == len(documents()) and {r["score"] for r in rows} == {0.0}
    _, real = labelled(spark)
    assert module.score(frame(spark, []), module.train(docs, real)).count() == 0


def test_quality_scores_and_filter(spark):
    docs, labels = labelled(spark)
    junk = [(1000 + i, "buy $$$ now !!! " * 40) for i in range(30)]
    docs = docs.unionAll(spark.createDataFrame(junk, "doc_id long, text string"))
    labels = labels.selectExpr("doc_id", "1 as quality").unionAll(
        spark.createDataFrame([(n, 0) for n, _ in junk], "doc_id long, quality int")
    )
    kept = {r["doc_id"] for r in quality_neighbours.keep_good(docs, labels).collect()}
    assert kept == set(range(80))
    every = quality_neighbours.score(frame(spark), quality_neighbours.train(docs, labels)).collect()
    assert len(every) == len(documents()) and all(0 <= r["score"] <= 1 for r in every)


def test_votes_are_those_of_all_exact_cosines(spark):
    """Scores against plain cosines with every labelled vector, ties among the nearest included."""
    docs = [(i, prose(i, 30 + i)) for i in range(40)] + [(100 + i, "buy $$$ now !!! " * (3 + i % 4)) for i in range(20)]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(20)]
    frame_, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality_neighbours.train(frame_, known)
    asked = docs + [(500, None), (501, ""), (502, docs[3][1]), (503, "x" * 5000)]
    got = quality_neighbours.score(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    assert len(got) == len(asked)
    for (number, text), row in zip(sorted(asked), sorted(got), strict=True):
        x = quality_neighbours.features((text or "").encode())
        v = quality_neighbours.weighted(x[None, :], model.idf)[0] @ model.directions
        length = np.sqrt((v**2).sum())
        near = sorted(((float(v @ w) / length if length else 0.0, y) for w, y in zip(model.vectors, model.labels, strict=True)), reverse=True)
        # Texts at one distance are the same text here, so which of them are taken does not matter.
        near = [(max(c, 0.0) ** 8, y) for c, y in near[: quality_neighbours.NEIGHBOURS]]
        expected = (sum(c * y for c, y in near) + 0.05 * model.prior) / (sum(c for c, _ in near) + 0.05)
        assert row["score"] == pytest.approx(expected, abs=1e-3), number


SECRET = "token=abcdefgh1234"


def test_base_spans():
    text = 'x password: "hunter2hunter2" token=short API_KEY = abcdefgh, AKIA1234567890AB AKIA123 ' + "0f" * 16
    expected = [(m.start(), 0, m.end()) for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 8]
    expected += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    expected += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    assert [s[:3] for s in secrets.find_spans(text)] == sorted(expected) and len(expected) == 4
    assert secrets.find_spans("\u017fecret=abcdefgh1 to\u212aen=abcdefgh1") == []  # letters beyond A to Z are others


def layers():
    raw = SECRET.encode()
    once = base64.b64encode(raw).decode()
    return [
        "".join(f"%{b:02x}" for b in raw), "".join(f"\\u{b:04x}" for b in raw), "".join(f"&#{b};" for b in raw),
        once, base64.b64encode(once.encode()).decode(), base64.b64encode(gzip.compress(raw)).decode(),
        urllib.parse.quote(base64.b64encode(zlib.compress(raw)).decode(), safe=""),
        base64.b64encode(("%20" + urllib.parse.quote(SECRET, safe="")).encode()).decode(),
    ]


@pytest.mark.parametrize("layer", layers())
def test_decoded_layers(layer):
    text = f"é before {layer} after"
    spans = secrets.find_spans(text)
    assert any(k == 0 and not base for _, k, _, base in spans)
    for start, _, end, _ in spans:
        assert 9 <= start < end <= 9 + len(layer)


def hidden():
    raw = SECRET.encode()
    once = base64.b64encode(raw).decode()
    long = base64.b64encode(b"some words before it, " * 5 + raw + b" and behind it" * 5).decode()
    members = gzip.compress(b"nothing here") + gzip.compress(raw)
    return [
        base64.b64encode(f"Zugang für Müller\n{SECRET}".encode()).decode(),
        base64.b64encode(b"\xff\xfe " + raw).decode(),
        *(f"https://x.com/{'c' * n}/{once}" for n in range(1, 5)),
        f"https://x.com/cb/{base64.b64encode(gzip.compress(raw)).decode()}",
        *("\n".join(long[i : i + n] for i in range(0, len(long), n)) for n in (76, 10)),
        "\r\n".join(long[i : i + 64] for i in range(0, len(long), 64)),
        base64.b64encode(members).decode(),
    ]


@pytest.mark.parametrize("layer", hidden())
def test_layers_within_runs_and_lines(layer):
    text = f"before {layer} after"
    spans = secrets.find_spans(text)
    assert any(k == 0 and not base for _, k, _, base in spans)
    for start, _, end, _ in spans:
        assert 7 <= start < end <= 7 + len(layer)


def odd_bytes():
    raw = SECRET.encode()
    small_window = zlib.compressobj(9, zlib.DEFLATED, 10)
    return [
        "M%FCller%20" + urllib.parse.quote(SECRET, safe=""),
        "\\ud800\\u0020" + "".join(f"\\u{b:04x}" for b in raw),
        urllib.parse.quote_from_bytes(gzip.compress(b"words " * 20 + raw)),
        *(base64.b64encode(f"einige Worte {SECRET} danach".encode(code)).decode() for code in ("utf-16", "utf-16-be")),
        "abc" + base64.b64encode(small_window.compress(b"words " * 20 + raw) + small_window.flush()).decode(),
        base64.b64encode(b"name.txt:" + gzip.compress(b"words " * 20 + raw)).decode(),
    ]


@pytest.mark.parametrize("layer", odd_bytes())
def test_layers_of_odd_bytes(layer):
    text = f"before {layer} after"
    spans = secrets.find_spans(text)
    assert any(k == 0 and not base for _, k, _, base in spans)
    for start, _, end, _ in spans:
        assert 7 <= start < end <= 7 + len(layer)


def test_a_large_stream_is_scanned_to_its_end():
    """In windows: all of it, in memory that does not grow with what it holds."""
    inner = b"".join(b"row %07d of filler\n" % i for i in range(150_000)) + SECRET.encode()
    assert len(inner) > 2 * secrets.WINDOW
    packed = base64.b64encode(zlib.compress(inner, 9)).decode()
    tracemalloc.start()
    spans = secrets.find_spans("x " + packed)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(k, s, e) for s, k, e, _ in spans] == [(0, 2, 2 + len(packed))]
    assert peak < 60 << 20


def test_scan_keeps_rows(spark):
    rows = secrets.scan(frame(spark)).select("row.doc_id", "row.row", "spans").collect()
    assert len(rows) == len(documents()) and all(r["spans"] == [] and r["row"] == "r" for r in rows)
    assert secrets.scan(frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def best_total(vocabulary, text):
    """Best score of a text by dynamic programming over all pieces."""
    value = {vocabulary.pieces[i]: vocabulary.scores[i] for i in vocabulary.plain}
    unknown = min(value.values()) - 10
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 20), end):
            part = text[start:end]
            if part in value:
                best[end] = max(best[end], best[start] + value[part])
        if text[end - 1] not in value:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_pieces_round_trip(vocabulary, text):
    encoder, decoder = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    assert decoder.decode(encoder.encode(text)) == text.replace("▁", " ")


def test_pieces_have_the_best_score(vocabulary):
    encoder = pieces.Encoder(vocabulary)
    for text in ["the cat sat", "internationalisation of things", "a  b", "x\ny", prose(5, 30)]:
        ids = encoder.encode(text).tolist()
        marked = "▁" + text.replace(" ", "▁")
        unknown = min(vocabulary.scores[i] for i in vocabulary.plain) - 10
        total = sum(vocabulary.scores[i] if i in vocabulary.plain else unknown for i in ids)
        assert total == pytest.approx(best_total(vocabulary, marked))


def test_pieces_equal_the_library(spark, vocabulary):
    """The library's own Viterbi, with the marks' extreme scores lowered as its floats are short."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    proto.ParseFromString(open(pieces.MODEL_PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    low = pieces.Vocabulary(
        vocabulary.pieces, tuple(max(s, -40000.0) for s in vocabulary.scores), vocabulary.plain, vocabulary.bytes_
    )
    encoder = pieces.Encoder(low)
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(200).collect()]
    lines = [x for t in texts for x in t.split("\n") if x and not set(x.replace(" ", "▁")) - encoder.singles]
    assert len(lines) > 500
    assert [encoder.encode(x).tolist() for x in lines] == library.encode(lines)


def test_pieces_over_a_frame(spark, vocabulary):
    encoded = pieces.encode(frame(spark), vocabulary)
    back = pieces.decode(encoded.selectExpr("row.text", "ids as p"), vocabulary, "p")
    for r in back.select("row.text", "decoded").collect():
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")
    assert pieces.encode(frame(spark, []), vocabulary).count() == 0
