"""SentencePiece search, token counts, personal data, toxicity and WARC."""

import base64
import hashlib
import os
import re
from array import array

import numpy as np
import pytest

from tesserae.llm import counts, pieces, pii, toxicity, warc
from tests.llm.cases import LONG, PASSAGE, ROWS, documents, empty

TEXTS = [r[1] for r in ROWS if r[1]] + ["don't they're we'll 're !'s", "hi<|endoftext|>!!<|startoftext|> x <|endoftex", "\x1c a\x85b", "İstanbul ΣΑΣ é", " lead  trail ", "1234 3.14"]


@pytest.fixture(scope="module")
def model():
    return pieces.Model(pieces.model_bytes(), 4)


def nbest(model, text):
    [(_, best)] = model.encode([text])
    return best


def as_unigram(data):
    """The model file with its kind changed, so that the library searches the same lattice."""

    def varint(x):
        out = bytearray()
        while True:
            out.append(x & 127 | (128 if x > 127 else 0))
            x >>= 7
            if not x:
                return bytes(out)

    def message(fields):
        return b"".join(varint(k << 3 | (0 if isinstance(v, int) else 2)) + (varint(v) if isinstance(v, int) else varint(len(v)) + v) for k, v in fields)

    at = data.index(message([(3, 2)]) + message([(4, 32000)]))
    return data[:at] + message([(3, 1)]) + data[at + 2 :]


def test_nbest_equals_the_library(model):
    import sentencepiece

    data = pieces.model_bytes()
    library = sentencepiece.SentencePieceProcessor(model_proto=as_unigram(data))
    score = {i: s for s, i in model.score.values()}
    total = lambda ids: sum(score.get(i, 0) for i in ids)
    for text in ["hello world", "a", "The quick  brown", " lead", "seven silver foxes", "naïve façade"]:
        mine, theirs = [list(array("i", ids)) for _, ids in nbest(model, text)], library.nbest_encode_as_ids(text, 4)
        assert [total(x) for x in mine] == [total(x) for x in theirs]
        assert mine[0] == theirs[0] or total(mine[0]) == total(theirs[0])


def test_pieces_round_trip(spark, model):
    for text in TEXTS:
        best = nbest(model, text)
        assert model.decode(best[0][1]) == text
        scores = [s for s, _ in best]
        assert scores == sorted(scores, reverse=True) and len({ids for _, ids in best}) == len(best)
        assert all(model.decode(ids) == text for _, ids in best)
    out = pieces.encoded(documents(spark))
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(r.decoded == (r.text or "") for r in rows) and "score" in out.columns
    assert all(len(r.nbest) == len(r.scores) and r.agrees == (r.nbest[0] == r.pieces) for r in rows)
    assert all(r.round_trip for r in pieces.digest(documents(spark)).collect())
    assert pieces.digest(empty(spark)).count() == 0


def test_pieces_are_the_library_s(model):
    import pyarrow.parquet as pq
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_bytes())
    texts = [*TEXTS, "  ", "\n", "a▁b", "x\ty\n\nz", "\x00 \x07"]
    if os.path.exists(at := "/root/testdata/sf0.001/documents.parquet"):
        texts += pq.read_table(at).column("text").to_pylist()
    for text, (ids, _) in zip(texts, model.encode(texts), strict=True):
        assert list(array("i", ids)) == library.encode(text or ""), text


def test_nbest_of_whole_texts_by_brute_force(model):
    """All N best of a text against an N-best Viterbi over its whole lattice, uncut."""

    def brute(text):
        s = pieces.MARK + text.replace(" ", pieces.MARK)
        tops = [[(0.0, ())], *[[] for _ in s]]
        for b in range(1, len(s) + 1):
            found = []
            for a in range(max(0, b - 20), b):
                if (got := model.score.get(s[a:b])) is not None:
                    found += [(x + got[0], (*ids, got[1])) for x, ids in tops[a]]
            if s[b - 1] not in model.singles:
                found += [(x + model.low, (*ids, *model.ids(s, [(-1, b - 1, b)]))) for x, ids in tops[b - 1]]
            tops[b] = sorted(found, reverse=True)[: model.n]
        return tops[-1]

    for text in ["The quick, brown fox; it's 12 o'clock.", "naïve façade 日本語 🙂 ok", " a  b ", "####!! (see [1], [2])", "\tx\n\ny", PASSAGE]:
        got, want = nbest(model, text), brute(text)
        assert [round(s, 3) for s, _ in got] == [round(s, 3) for s, _ in want], text


def test_small_caches_change_nothing():
    tight, roomy = pieces.Model(pieces.model_bytes(), 4, cache_bytes=1), pieces.Model(pieces.model_bytes(), 4)
    few, many = counts.Counter(counts.vocabulary(), cache_bytes=1), counts.Counter(counts.vocabulary())
    for text in TEXTS:
        assert list(tight.encode([text])) == list(roomy.encode([text]))
        assert few.table(text).tolist() == many.table(text).tolist()


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        counts.Counter(counts.vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


def test_nbest_by_enumeration(model):
    def paths(s):
        if not s:
            yield 0.0, ()
        for k in range(1, len(s) + 1):
            if (got := model.score.get(s[:k])) is not None:
                for x, rest in paths(s[k:]):
                    yield got[0] + x, (got[1], *rest)

    for word in ("▁them", "▁and", "tion"):
        want = sorted((x for x, _ in paths(word)), reverse=True)[:4]
        assert [x for x, _ in model.search(word, 4)[0]] == want


@pytest.fixture(scope="module")
def counter():
    return counts.Counter(counts.vocabulary())


def test_counts_of_all_prefixes(counter):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(counts.vocabulary())
    n = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    for text in TEXTS:
        assert counter.table(text)[-1] == n(text)
    for text in ["don't they're we'll 're !'s", "hi<|endoftext|>!!x<|endoftex", "naïve façade 日本語 🙂", "the 1234 quick, brown foxes"]:
        table = counter.table(text)
        assert table.tolist() == [n(text[:k]) for k in range(len(text) + 1)]
        for budget in (0, 1, 5, 100):
            k = counts.longest_prefix(table, budget)
            assert table[k] <= budget and all(x > budget for x in table[k + 1 :])


def test_counted(spark, counter):
    rows = counts.counted(documents(spark)).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)) for r in rows) == sorted(
        str((r[0], len((r[1] or "").encode()), int(counter.table(r[1])[-1]), bool(counter.table(r[1])[-1] > 2048))) for r in ROWS
    )
    assert any(r.over_limit and r.fits < len(LONG) for r in rows)
    assert all(len(r.prefix_tokens) > 0 for r in counts.tables(documents(spark)).collect())
    assert counts.counted(empty(spark)).count() == 0


MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    t = t or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = [(0, *m.span()) for m in MAIL.finditer(t)]
    out += [(1, *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]


def test_base_spans():
    odd = ["a@b@c.de", "x..@y.z", "a.b@c.d.e. x@y", "1.2.3.4.5.6.7.8 999.1.1.1 000255.1.1.1", "+1 (726) 555-7857 + +12", "@@a@b.c", "9" * 40, "4111-1111 1111-1111", "٣.1.2.3.4", "a@b.c@d.e"]
    for t in odd + TEXTS:
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "@") == []


def test_pii_digest_and_terms(spark):
    rows = [*[(r[0], r[1]) for r in ROWS], *[(50 + k, f"ask the zanzibarian about bob{k % 2}@corp.example now") for k in range(6)], *[(70 + k, "the about now ask") for k in range(60)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.base_sha256): r for r in pii.digest(docs).collect()}
    assert sum(1 for _ in pii.digest(docs).collect()) == len(rows)
    for d, t in rows:
        base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(t))
        r = got[d, hashlib.sha256(base.encode()).hexdigest()]
        assert r.spans.startswith(base)
    assert "term:8:19" not in got[50, hashlib.sha256(b"email:26:43").hexdigest()].spans  # it stands beside two entities
    only = [(k, f"here is {'quux' if k < 5 else 'some'} mail {'q@corp.example' if k < 5 else ''}") for k in range(50)]
    told = {r.doc_id: r.spans for r in pii.digest(spark.createDataFrame(only, "doc_id long, text string")).collect()}
    assert "term:8:12" in told[0] and told[9] == ""
    out = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(only, "doc_id long, text string")).collect()}
    assert out[9] == only[9][1] and "quux" not in out[0] and "<EMAIL>" in out[0] and len(out) == 50
    assert pii.sanitise(documents(spark)).count() == len(ROWS) and pii.digest(empty(spark)).count() == 0


def test_pii_terms_of_the_whole_document(spark, monkeypatch):
    far = "Quuxley spoke of the weather and of many other things in this house. Later quuxley gave q.quuxley@corp.example to us, then QUUXLEY left."
    rows = [(k, far if k < 5 else "we write and spoke of the weather and of many other things in this house. Later some gave it to us, then they left.") for k in range(60)]
    rows += [(100 + k, "write to q.quuxley@corp.example then") for k in range(3)]  # holds the term inside the address only
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    at = [m.span() for m in re.finditer("quuxley", far.lower())]
    want = ",".join(["email:%d:%d" % (at[2][0] - 2, at[2][1] + 13), *["term:%d:%d" % x for x in (at[0], at[1], at[3])]])
    for few in (pii.BROADCAST_TERMS, 0):
        monkeypatch.setattr(pii, "BROADCAST_TERMS", few)
        monkeypatch.setattr(pii, "BROADCAST_FOUND", few)
        told = {r.doc_id: r.spans for r in pii.digest(docs).collect()}
        assert told[0] == want and told[9] == "" and told[100] == "email:9:31"
        out = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
        assert "quuxley" not in out[0].lower() and out[9] == rows[9][1] and len(out) == len(rows)


def test_network_gradient():
    net, rng = toxicity.Network(1), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask, y = rng.standard_normal((5, 3, 2 * toxicity.DIM)), np.ones((5, 3)), np.array([1.0, 0.0, 1.0])
    mask[4, 1] = 0

    def loss():
        z = net.project(x)
        h = 3 * toxicity.HIDDEN
        p = toxicity.sigmoid(net.pooled(z[..., :h], z[..., h:], mask)[0])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads, dx = net.step(x, mask, y, np.ones(3))
    for name in ("o", "v", "A", "Uf", "Ub", "Wf", "cb"):
        at = tuple(0 for _ in net.p[name].shape)
        old, e = net.p[name][at], 1e-4
        net.p[name][at] = old + e
        up = loss()
        net.p[name][at] = old - e
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / (2 * e) - grads[name][at]) < 2e-3, name


def test_windows_cover_all_words():
    for sizes in ([0, 1, 48, 49, 500], [3], [0]):
        windows, owner = toxicity.cut(np.arange(1, sum(sizes) + 1), sizes)
        assert set(windows[windows > 0].tolist()) == set(range(1, sum(sizes) + 1)) and set(owner.tolist()) == set(range(len(sizes)))


def test_scores_are_the_highest_of_all_windows():
    rng = np.random.default_rng(3)
    net = toxicity.Network(4)
    net.p["o"] *= 9
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 300, n)) for n in [0, 1, 3, 47, 48, 49, 50, 95, 700, 2500, *rng.integers(1, 60, 90)]] + [None]
    got = toxicity.Scorer(net).scores(texts)
    for text, score in zip(texts, got, strict=True):
        words = toxicity.tokens(text)
        logits = []
        for k in range(max(1, len(words) - toxicity.WINDOW + 1)):
            some = words[k : k + toxicity.WINDOW]
            x = np.zeros((toxicity.WINDOW, 1, 2 * toxicity.DIM), np.float32)
            if some:
                x[: len(some), 0] = toxicity.Vocabulary(some).vectors(net, np.arange(len(some)))
            mask = (np.arange(toxicity.WINDOW) < len(some)).astype(np.float32)[:, None]
            z, h = net.project(x), 3 * toxicity.HIDDEN
            logits.append(net.pooled(z[..., :h], z[..., h:], mask)[0][0])
        assert abs(toxicity.sigmoid(max(logits)) - score) < 1e-4


def plain_score(net, text):
    """The highest of all windows, one network pass each, with attention everywhere."""
    words, best = toxicity.tokens(text), -np.inf
    for k in range(max(1, len(words) - toxicity.WINDOW + 1)):
        some = words[k : k + toxicity.WINDOW]
        x = np.zeros((toxicity.WINDOW, 1, 2 * toxicity.DIM), np.float32)
        if some:
            x[: len(some), 0] = toxicity.Vocabulary(some).vectors(net, np.arange(len(some)))
        z, h = net.project(x), 3 * toxicity.HIDDEN
        best = max(best, net.pooled(z[..., :h], z[..., h:], (np.arange(toxicity.WINDOW) < len(some)).astype(np.float32)[:, None])[0][0])
    return toxicity.sigmoid(best)


def test_attention_only_where_a_window_can_be_the_highest(monkeypatch):
    rng = np.random.default_rng(8)
    net = toxicity.Network(6)
    net.p["o"] *= 5
    for sizes, chunk in (([900, 3, 2000, 0, 40], 4096), ([900, 3, 2000, 0, 40], 64), (rng.integers(0, 12, 300), 128)):
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        texts = [" ".join(f"w{k}" for k in rng.integers(0, 400, n)) for n in sizes]
        scorer, seen = toxicity.Scorer(net), []
        plain = scorer.attended
        monkeypatch.setattr(scorer, "attended", lambda s, *more: seen.append(s.shape[2]) or plain(s, *more))  # noqa: B023
        got = scorer.scores(texts)
        assert np.abs(got - [plain_score(net, t) for t in texts]).max() < 1e-5
        windows = sum(max(1, n - toxicity.WINDOW + 1) for n in sizes)
        assert sum(seen) < 0.6 * windows or max(sizes) < 12 and sum(seen) <= windows


def test_frequent_words_stay_when_the_table_is_full(monkeypatch):
    net = toxicity.Network(2)
    texts = [" ".join(["often", "again", *(f"new{k}x{i}" for i in range(30)), "often", "again"]) for k in range(40)]
    scorer, added = toxicity.Scorer(net, cached=100), []
    plain = scorer.put
    monkeypatch.setattr(scorer, "put", lambda at, x: added.append(len(x)) or plain(at, x))
    got = np.concatenate([scorer.scores([t]) for t in texts])
    assert np.abs(got - [plain_score(net, t) for t in texts]).max() < 1e-5
    distinct = len({w for t in texts for w in t.split()})
    assert sum(n for n in added if n > 1) == distinct  # none is computed twice, as those that come again are kept
    assert len(scorer.index) <= 100


def test_long_words_are_cut_in_overlapping_parts():
    for n in (1, 24, 25, 36, 37, 5000):
        word = "".join(chr(0x4E00 + k) for k in range(n))
        parts = toxicity.tokens(f"a {word} b")
        assert parts[0] == "a" and parts[-1] == "b" and all(len(p) <= toxicity.PART for p in parts)
        assert all(any(word[k : k + toxicity.OVERLAP] in p for p in parts) for k in range(n))


def test_toxicity_learns(spark):
    rng = np.random.default_rng(5)
    plain = ["river", "stone", "cloud", "garden", "window", "letter", "music", "paper", "winter", "silver"]
    rows = []
    for k in range(600):
        words = rng.choice(plain, rng.integers(20, 120)).tolist()
        if k % 4 == 0:
            words.insert(int(rng.integers(0, len(words))), f"vilek{rng.choice(list('abcde'))}")
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    docs = spark.createDataFrame([(d, t, "en") for d, t, _ in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    got = toxicity.assess(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and 100 < len(held) < 300
    assert sum((r.predicted == 1) == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.97
    net = toxicity.train(docs, labels)
    odd = toxicity.score(documents(spark), net).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(empty(spark), net).count() == 0
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_warc(spark):
    rows = [(1, "a\nb", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (None, "u", "x"), (None, "v", "y"), (7, "q", "z\r\n\r\nWARC/1.1"), (7, "q", "z\r\n\r\nWARC/1.1"), (8, "é", LONG)]
    top = {}
    for p, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if p is None else p)
    want = []
    for p, _, h in rows:
        data = (h or "").encode()
        first = top[h or ""]
        again = first != -1 and p != first
        want.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first if again else None))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=str) == sorted(want, key=str)
    assert warc.round_trip(pages.where("1 = 0")).count() == 0


def test_warc_file_is_standard_frames():
    import zstandard

    many = [warc.record(k, f"http://x/{k}", f"<html>{k} {LONG[k : k + 800]}</html>".encode(), None, False) for k in range(300)]
    data = warc.archive(many)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and len(data) < sum(map(len, many))
    size = int.from_bytes(data[4:8], "little")
    held = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    first = zstandard.ZstdDecompressor(dict_data=held).decompressobj()
    assert first.decompress(data[8 + size :]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and first.unused_data
    assert [b for h, b in warc.records(data) if h["warc-type"] == "response"] == [m.partition(b"\r\n\r\n")[2][:-4] for m in many]
