"""Operators on single texts: classifier, pieces, token counts, outliers."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_pb
from tokenizers import Tokenizer

from emberlog.llm import gam, outliers, pieces, token_counts
from emberlog.llm.common import n_words

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "a", "  two  spaces ", "\n\n", "tab\tand\x0bother\x1cspace\x85s", "Ünïcödé ßtraße ΑΣ İ", "日本語のテキスト",
    "😀 é ́x", "▁x y▁▁ z", "it's I'LL 's", "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>x<|endoftext|",
    "\x00\x01 �", "word " * 3000, "x" * 5000, "a\nb\na\n\n\nb", "Ｆｕｌｌ ｗｉｄｔｈ １２３",
]


@pytest.fixture(scope="module")
def odd(rows):
    data = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "a"), (3, "a")]
    return rows(data, clash=True)


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


# --- token counts --------------------------------------------------------------
def library_counts(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("head", [1 << 17, 3])
def test_token_counts_are_the_librarys(odd, head):
    got = token_counts.count_tokens(odd, head=head).collect()
    assert len(got) == odd.count()
    want = dict(zip(range(len(ODD)), library_counts(ODD), strict=True))
    for r in got:
        if r["doc_id"] is not None:
            text = ODD[r["doc_id"]] or ""
            assert (r["n_tokens"], r["n_bytes"]) == (want[r["doc_id"]], len(text.encode())), text
            assert r["over_limit"] == (r["n_tokens"] > 2048)
    assert [r["n_tokens"] for r in got if r["doc_id"] is None] == library_counts(["null id"])


def test_token_counts_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = texts_of(docs)
    want = dict(zip(texts, library_counts(texts.values()), strict=True))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.op6_token_counts(spark, SF).collect()}
    assert got == want


def test_token_counts_of_nothing(rows):
    assert token_counts.count_tokens(rows([])).count() == 0


# --- pieces ----------------------------------------------------------------------
def brute_force(table, text):
    """Best ids by trying every piece at every place; ties to the longer last piece."""
    best = [(0.0, [])] + [None] * len(text)
    score_of = {p: (s, i) for i, (p, s) in table.items()}
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            options = []
            if piece in score_of:
                options.append((score_of[piece][0], [score_of[piece][1]]))
            elif len(piece) == 1:
                options.append((-1e9 - 10, [3 + b for b in piece.encode()]))
            for s, ids in options:
                total = best[start][0] + s
                if best[end] is None or total > best[end][0]:
                    best[end] = (total, best[start][1] + ids)
    return best[-1][1]


@pytest.fixture(scope="module")
def piece_model():
    model = model_pb.ModelProto()
    with open(public_tokenizers.path(pieces.MODEL), "rb") as f:
        model.ParseFromString(f.read())
    return model


def test_viterbi_is_the_best_segmentation(piece_model):
    encoder = pieces.pieces(public_tokenizers.path(pieces.MODEL))
    table = {i: (p.piece, p.score) for i, p in enumerate(piece_model.pieces) if p.type == 1}
    r = random.Random(7)
    for _ in range(60):
        text = "".join(r.choice("the and of tion ß é 日 \n x") for _ in range(r.randint(1, 24)))
        assert encoder.encode(text) == brute_force(table, "▁" + text.replace(" ", "▁")), text


def test_no_segmentation_of_the_library_scores_higher(spark, piece_model):
    """The library merges pairs by rank, so its pieces of the same vocabulary differ; their sum is never better."""
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    own = pieces.pieces(public_tokenizers.path(pieces.MODEL))
    score = [p.score for p in piece_model.pieces]
    checked = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        line = " ".join(r["text"].split()[:12])
        ids, best = library.encode(line), own.encode(line)
        if min(best) > 258:  # byte pieces carry no score of their own
            assert sum(score[i] for i in best) >= sum(score[i] for i in ids)
            checked += 1
    assert checked > 50


def test_every_text_comes_back(odd):
    got = pieces.encode_documents(odd)
    assert "text" not in got.columns and got.columns.count("ids") == 1 and "score" in got.columns
    assert got.where("not round_trip").count() == 0 and got.count() == odd.count()
    back = pieces.decode_documents(got.select("doc_id", "ids")).collect()
    for r in back:
        if r["doc_id"] is not None:
            assert r["text"] == (ODD[r["doc_id"]] or "")
    assert {tuple(r["ids"]) for r in got.where("doc_id in (0, 1)").collect()} == {()}


def test_batches_cut_by_characters_lose_no_row(rows, monkeypatch):
    data = rows([(i, t) for i, t in enumerate(["a b", None, "", "long text " * 20, "x", "y" * 9, ""])]).coalesce(1)
    whole = {x["doc_id"]: (x["ids"], x["round_trip"]) for x in pieces.encode_documents(data).collect()}
    monkeypatch.setattr(pieces, "CHARACTERS", 5)
    assert {x["doc_id"]: (x["ids"], x["round_trip"]) for x in pieces.encode_documents(data).collect()} == whole
    assert len(whole) == 7 and all(same for _, same in whole.values())


def test_pieces_of_nothing(rows):
    assert pieces.encode_documents(rows([])).count() == 0


# --- classifier ------------------------------------------------------------------
def test_learns_from_the_open_folds_and_holds_on_the_other(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = gam.score_quality(docs, gam.train(docs, labels)).join(labels, "doc_id")
    rows = scored.select("doc_id", "quality", "score", "predicted").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    good = [r["predicted"] == r["quality"] for r in held]
    assert len(held) > 500 and sum(good) / len(good) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_held_out_labels_are_never_learned(rows):
    ids = list(range(200))
    docs = rows([(i, "word " * (i % 7 + 1)) for i in ids])
    open_ = [i for i in ids if zlib.crc32(str(i).encode()) % 4 != 2]
    some = rows([(i, i % 2) for i in open_], "doc_id bigint, quality int")
    more = rows([(i, i % 2 if i in open_ else 1 - i % 2) for i in ids], "doc_id bigint, quality int")
    a, b = (gam.train(docs, x) for x in (some, more))
    assert a.bias == b.bias and all((s == t).all() for s, t in zip(a.tables, b.tables, strict=True))


def test_a_pair_is_learned_where_single_features_say_nothing():
    x = np.zeros((400, len(gam.FEATURES)))
    r = np.random.default_rng(1)
    x[:, 1], x[:, 2] = r.random(400), r.random(400)
    y = ((x[:, 1] > 0.5) != (x[:, 2] > 0.5)).astype(float)
    model = gam.fit(x, y, rounds=5)
    assert (1, 2) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.9


def test_scores_of_odd_rows(odd, rows):
    none = rows([], "doc_id bigint, quality int")
    model = gam.train(odd, none)
    scored = gam.score_quality(odd, model).collect()
    assert len(scored) == odd.count() and all(r["predicted"] == 1 for r in scored)
    nulls = rows([(None, 1), (1, None), (1, 1), (1, 1), (2, 7)], "doc_id bigint, quality int")
    assert 0.5 < gam.train(odd, nulls).score(np.zeros((1, len(gam.FEATURES))))[0] <= 1
    assert gam.score_quality(rows([]), model).count() == 0


# --- quality rules -----------------------------------------------------------------
def plain_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 1500 else set(windows)
    marked = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines, seen, dups = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dups, len(marked)


def test_counts_of_odd_texts():
    r = random.Random(2)
    mixed = [" ".join(r.choice("abcd") for _ in range(r.randint(0, 40))) for _ in range(200)]
    for text in [t for t in ODD if not t or len(t) < 10_000] + mixed:
        assert outliers.text_counts(text)[:5] == plain_counts(text), text


def test_base_rules_and_junk(spark, rows):
    r = random.Random(4)
    word = lambda: "".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 9)))
    good = [" ".join(word() for _ in range(r.randint(60, 300))) + "." for _ in range(300)]
    junk = [" ".join(word() + "###" for _ in range(100)) for _ in range(30)]
    data = [(i, t, "en", None) for i, t in enumerate(good)] + [(1000 + i, t, "en", None) for i, t in enumerate(junk)]
    data += [(2000, None, None, "s"), (2001, "", "en", "s"), (2002, "a b c " * 40, "en", "s"), (2003, good[0], "xx", None)]
    docs = rows(data + data[:2], "doc_id bigint, text string, lang string, source string", clash=True)
    got = {x["doc_id"]: x for x in outliers.quality_rules(docs).collect()}
    assert len(got) == 334 and outliers.quality_rules(docs).count() == 336
    assert sum(got[i]["kept"] for i in range(300)) >= 298
    assert not any(got[1000 + i]["kept"] for i in range(30))
    assert [got[i]["base_failed"] for i in (2000, 2001, 2002, 2003)] == [True, True, True, False]
    assert got[2003]["kept"] and got[2000]["n_words"] == 0


def test_a_source_with_a_third_and_with_nearly_half_of_junk(rows):
    r = random.Random(12)
    word = lambda: "".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 9)))
    good = lambda: " ".join(word() for _ in range(r.randint(60, 200))) + "."
    junk = lambda: " ".join(word() + "###" for _ in range(80))
    data = []
    for source, n, bad in (("third", 134, 66), ("half", 110, 90), ("small", 30, 15)):
        data += [(len(data) + i, (good if i < n else junk)(), "en", source) for i in range(n + bad)]
    docs = rows(data, "doc_id bigint, text string, lang string, source string")
    kept = {x["doc_id"]: x["kept"] for x in outliers.quality_rules(docs).collect()}
    wrong = [(d[3], "###" in d[1]) for d in data if kept[d[0]] == ("###" in d[1])]
    assert not any(bad for _, bad in wrong) and len(wrong) <= 3, wrong


def test_no_documents(rows):
    docs = rows([], "doc_id bigint, text string, lang string, source string")
    assert outliers.quality_rules(docs).count() == 0


def test_estimate_is_that_of_the_inner_rows(rows):
    """Distributed concentration steps against numpy's."""
    r = np.random.default_rng(5)
    x = np.vstack([r.normal(size=(700, 2)) @ [[1, 0.4], [0, 0.5]] + 3, r.normal(size=(150, 2)) + 30])
    floor = (0.01, 0.01)
    df = rows([("g", *map(float, v)) for v in x], "grp string, a double, b double")
    got = outliers.estimate(df, ("a", "b"), floor).first()
    m = np.median(x, 0)
    inv = np.diag(1 / ((np.median(abs(x - m), 0) * 1.4826) ** 2 + np.square(floor)))
    for _ in range(outliers.STEPS):
        d = np.einsum("ij,jk,ik->i", x - m, inv, x - m)
        inner = x[d <= np.sort(d)[int(np.ceil(0.75 * len(d))) - 1]]
        m = inner.mean(0)
        inv = np.linalg.inv(outliers.consistency(0.75, 2) * np.cov(inner.T, bias=True) + np.diag(np.square(floor)))
    assert np.allclose(got["centre"], m, atol=0.02) and abs(m[0] - 3) < 0.5
    assert np.allclose(got["inverse"], inv[np.triu_indices(2)], rtol=0.05)


def test_chi_square():
    assert abs(outliers.chi_square_quantile(0.95, 2) - 5.9915) < 1e-3
    assert abs(outliers.chi_square_quantile(0.975, 6) - 14.4494) < 1e-3


def test_words(rows):
    import re

    for r in rows([(i, t) for i, t in enumerate(ODD)]).select("text", n_words("text").alias("n")).collect():
        assert r["n"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))


def test_models_that_cannot_be_honoured_are_refused(tmp_path):
    import public_tokenizers
    import pytest
    from sentencepiece import sentencepiece_model_pb2 as model_pb

    def saved(change):
        model = model_pb.ModelProto()
        with open(public_tokenizers.path(pieces.MODEL), "rb") as f:
            model.ParseFromString(f.read())
        change(model)
        (tmp_path / "m.model").write_bytes(model.SerializeToString())
        return str(tmp_path / "m.model")

    def without_bytes(model):
        for p in model.pieces:
            p.type = 1 if p.type == pieces.BYTE else p.type

    def with_own_piece(model):
        model.pieces.add(piece="<mine>", score=0.0, type=pieces.USER_DEFINED)

    def with_rules(model):
        model.normalizer_spec.precompiled_charsmap = b"x"

    assert pieces.Pieces.read(saved(lambda model: None)).encode("a b")
    for change in (without_bytes, with_own_piece, with_rules):
        with pytest.raises(ValueError):
            pieces.Pieces.read(saved(change))
