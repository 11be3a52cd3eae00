"""Language ID, token counts, license scans and pieces against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from tokenizers import Tokenizer

from unilake.llm import language_id, license_scan, pieces, setkit, textkit, token_count
from tests.llm.conftest import SF

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a  b\n\tc ", "don't 'tis we'LL we'll they've''s I'm 'sabc x'd'", "é😀 ñandú 　x ١٢٣ ½ a1b2",
       "a<|endoftext|>b <|endoftext|><|endoftext|> 's", "x" * 5000, " \n \n\n  y", "\r\n\r\n", "中文字符 テスト", "'", "''", "' s", "a 's",
       "\x00\x01", "_-=+ ...!?", "▁x ▁", "tab\tend\t", "…—“quoted”", "🇩🇪👩‍👩‍👧", "ﬁ ǅ ʰ x́", "word " * 300]


def fuzz(n, seed):
    rng = random.Random(seed)
    bits = ["'", "s", "re", "ll", "ve", " ", "  ", "\n", "\t", " ", "1", "½", "é", "中", "!", "?.", "abc", "THE", "<|endoftext|>", "😀"]
    return ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(n)]


def odd_rows():
    return [(i, t) for i, t in enumerate(ODD + fuzz(120, 5))] + [(3, ODD[3])]


def token_truth(rows):
    library = Tokenizer.from_file(BPE)
    out = Counter()
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        out[(i, len((t or "").encode()), n, n > 1024)] += 1
    return out


@pytest.mark.parametrize("hot", [1 << 18, 3])
def test_token_counts_of_odd_texts(make_docs, monkeypatch, hot):
    monkeypatch.setattr(token_count, "HOT", hot)
    rows = odd_rows()
    got = token_count.count_tokens(make_docs(rows).repartition(3), BPE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(tuple(r) for r in got.collect()) == token_truth(rows)


def test_token_counts_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(tuple(r) for r in token_count.count_tokens(docs, BPE).collect()) == token_truth(rows)


def test_code_points_that_python_does_not_know(make_docs):
    """Split as the library does, whose Unicode is newer."""
    import unicodedata
    unknown = [i for i in range(0x40000) if unicodedata.category(chr(i)) == "Cn"][::7]
    rows = [(k, "".join(f"a{chr(i)}1{chr(i)}!{chr(i)} {chr(i)}" for i in unknown[k:k + 40])) for k in range(0, len(unknown), 40)]
    assert Counter(tuple(r) for r in token_count.count_tokens(make_docs(rows), BPE).collect()) == token_truth(rows)


def test_pretokens_with_one_hash_are_hashed_anew(make_docs, monkeypatch):
    hashes = token_count.span_hashes
    monkeypatch.setattr(token_count, "span_hashes", lambda d, s, e, seed=0: (
        (e - s).astype(np.uint64) if seed == 0 else hashes(d, s, e, seed)))
    rows = odd_rows()
    assert Counter(tuple(r) for r in token_count.count_tokens(make_docs(rows), BPE).collect()) == token_truth(rows)


def test_token_counts_empty(make_docs):
    assert token_count.count_tokens(make_docs([]), BPE).collect() == []


def test_languages(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = language_id.languages(docs).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in truth}
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def plain_languages(rows):
    """Predictions by a dict of trigram vectors, one character at a time.
    ``rows``: (doc_id, text, lang)."""
    one = {}

    def letter(c):
        if c not in one:
            one[c] = language_id.letter_vectors(np.array([ord(c)]))[0].astype(float)
        return one[c]

    def bundle(text):
        kept = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
        kept = " " + re.sub(" +", " ", kept).strip(" ") + " "
        if not kept.strip():
            return None
        grams = [kept[i:i + 3] for i in range(len(kept) - 2)]
        return sum(np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c) for a, b, c in grams), len(grams)

    def fold(i):
        return zlib.crc32(("null" if i is None else str(i)).encode()) % 4 == 2

    bundles = [bundle(t) for _, t, _ in rows]
    protos = {}
    for (i, _, lang), b in zip(rows, bundles, strict=True):
        if lang is not None and b is not None and not fold(i):
            protos[lang] = protos.get(lang, 0) + b[0] / b[1]
    out = []
    for (i, _, _), b in zip(rows, bundles, strict=True):
        cos = {} if b is None else {k: float(b[0] @ p / np.linalg.norm(b[0]) / np.linalg.norm(p)) for k, p in protos.items()}
        best = sorted(cos, key=lambda k: (-cos[k], k))
        margin = cos[best[0]] - cos[best[1]] if len(best) > 1 else 1.0
        out.append((i, fold(i), best[0] if best else "und", min(max(cos[best[0]], 0), 1) if best else 0.0, margin))
    return out


def test_languages_against_plain_vectors(spark, make_docs):
    table = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [r for r in table if r[1] is None or len(r[1]) < 3000][:120]
    rows += [(None, "the  THE's thé", "en"), (None, None, "en"), (7, "", None), (7, "12 34 !", "de"), (7, "Straße ǅ İ", None),
             (8, "中文 字符", "zh"), (8, "中文 字符", "zh"), (9, "x", "fr"), (9, "x", "fr")]
    got = language_id.languages(make_docs(rows).repartition(3)).collect()
    want = plain_languages(rows)
    key = lambda r: (str(r[0]), r[1], r[3])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:2] == w[:2] and abs(g[3] - w[3]) < 1e-3 and (g[2] == w[2] or w[4] < 1e-3)


def test_language_cases(make_docs):
    rows = [(i, "the cat and the dog", "en", "a") for i in range(8)] + \
        [(i, "der hund und die katze", "de", "a") for i in range(10, 18)] + \
        [(20, None, "en", "a"), (21, "", "en"), (22, "12 34 !?", "de"), (23, "the dog"), (24, "die katze und", None, None),
         (25, "x " * 9000, "en", "a"), (None, "the cat", "en", "a"), (26, "Ω", None, None)]
    got = {r["doc_id"]: r for r in language_id.languages(make_docs(rows)).collect()}
    assert len(got) == len(rows)
    assert [got[i]["lang_pred"] for i in (20, 21, 22, 23, 24)] == ["und", "und", "und", "en", "de"]
    assert got[20]["score"] == 0.0
    kept = language_id.accepted(make_docs(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {20, 21, 22}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.count() >= len(rows) - 4
    assert language_id.languages(make_docs([])).collect() == []
    assert [r["lang_pred"] for r in language_id.languages(make_docs([(1, "abc")])).collect()] == ["und"]


def test_letter_vectors_are_random_and_fixed():
    v = language_id.letter_vectors(np.array([97, 98, 0x4E2D]))
    assert set(np.unique(v)) == {-1.0, 1.0} and (v == language_id.letter_vectors(np.array([97, 98, 0x4E2D]))).all()
    assert abs(v @ v.T / language_id.DIMENSIONS - np.eye(3)).max() < 0.2


#: The truth's own rule: the word that names a license and the edits it may hold;
#: words that name another license in its place are no such license.
OWN_NAMES = {"apache-notice": ("apache", 2), "cc-by-nc-notice": ("nc", 0), "cc-by-sa-notice": ("sa", 0),
             "mit-notice": ("mit", 0), "mpl-notice": ("mozilla", 2)}


def edits(pattern, text, anchored):
    """Least edits of ``pattern`` against a text's beginnings (``anchored``: from
    its first character)."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [row[0] + 1 if anchored else 0]
        for i, p in enumerate(pattern, 1):
            new.append(min(new[-1] + 1, row[i] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def notice_stands(label, notice, text):
    """Whether the notice stands in the text: split at the name, its two sides and
    the name are aligned apart and their edits added up."""
    most = len(notice) // 10
    if label not in OWN_NAMES or not re.search(rf"\b{OWN_NAMES[label][0]}\b", notice):
        return regex.search(f"(?:{regex.escape(notice)}){{e<={most}}}", text) is not None
    name, own = OWN_NAMES[label]
    at = re.search(rf"\b{name}\b", notice).start()
    head, tail = notice[:at], notice[at + len(name):]
    before, after = re.findall("[a-z0-9.]+", head)[-1], re.findall("[a-z0-9.]+", tail)[0]
    if not regex.search(f"(?:{regex.escape(notice)}){{e<={most}}}", text):
        return False
    for i in range(len(text) + 1):
        for j in range(max(i, i + len(name) - own), min(len(text), i + len(name) + own) + 1):
            word = text[i:j]
            n = whole_edits(name, word) if own else 0
            if not own and (word != name or re.match("[a-z]", text[i - 1:i]) and not text[:i].endswith(before) \
                    or re.match("[a-z]", text[j:j + 1]) and not text[j:].startswith(after)) or n > own:
                continue
            left = text[max(0, i - len(head) - most):i][::-1]
            right = text[j:j + len(tail) + most]
            if n + edits(head[::-1], left, True) + edits(tail, right, True) <= most:
                return True
    return False


def whole_edits(a, b):
    row = list(range(len(a) + 1))
    for c in b:
        new = [row[0] + 1]
        for i, p in enumerate(a, 1):
            new.append(min(new[-1] + 1, row[i] + 1, row[i - 1] + (p != c)))
        row = new
    return row[-1]


def license_truth(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    base = [(i, x) for i in range(len(words)) for p, x in license_scan.PHRASES.items() if tuple(words[i:i + len(p)]) == p]
    fuzzy = {label for label, ns in license_scan.NOTICES.items() for n in ns if notice_stands(label, n, text)}
    own = {x for _, x in base}
    return (len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
            ",".join(sorted(own)), ",".join(sorted(own | fuzzy)))


COLS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]


def test_license_cases(make_docs):
    texts = [None, "", "All rights reserved. CC-BY cc by CC/BY-SA éCC by", "Licensd undr the Apche License, Version 2.O",
             "GENERAL public\n\nLicense general public licenses", "Released under thr MIT  license!", "ccby all rights  reserve d",
             "all-rights-reserved " * 800, "gnu lesser genral public licence", "all rights all rights reserved",
             "İ all rights reserved 中cc by"]
    rows = list(enumerate(texts)) + [(2, texts[2])]
    got = license_scan.license_report(make_docs(rows))
    assert Counter(tuple(r) for r in got.select(COLS).collect()) == Counter((i, *license_truth(t)) for i, t in rows)
    spans = {r["doc_id"]: r["spans"] for r in got.collect()}
    s = spans[3][0]
    assert s["label"] == "apache-notice" and texts[3][s["start"]:s["end"]].startswith("Licensd") and 0.85 < s["similarity"] < 1
    assert license_scan.license_report(make_docs([])).collect() == []


@pytest.mark.parametrize("text, label", [
    ("Released under the BSD license", ""), ("released under the gpl license", ""), ("released under the summit license", ""),
    ("licensed under cc by-nc 4.0", "cc-by-nc-notice"), ("licensed under cc by-sa 4.0", "cc-by-sa-notice"),
    ("licensed under cc by-nd 4.0", ""), ("licensd under cc bync 4.0", "cc-by-nc-notice"),
    ("licensed under the cpal license, version 2.0", ""), ("licensd under the apche license, version 2.0", "apache-notice"),
    ("subject to the terms of the nokia public license", ""),
    ("subject to terms of the mozila public license", "mpl-notice"),
    ("relased under teh MIT license", "mit-notice"), ("released under themit license", "mit-notice")])
def test_license_names_are_told_apart(text, label):
    found = license_scan.Finder().find(f"a. {text}; b".lower())
    assert ",".join(x[2] for x in found) == label


def test_license_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = Counter((r["doc_id"], *license_truth(r["text"])) for r in docs.collect())
    assert Counter(tuple(r) for r in license_scan.license_report(docs).select(COLS).collect()) == want


def viterbi(p, text, ids):
    """Plain recurrence over characters."""
    if not text:
        return []
    t = pieces.MARK + text.replace(" ", pieces.MARK)
    best = [(0.0, None, None)] + [(-float("inf"), None, None)] * len(t)
    for e in range(1, len(t) + 1):
        for s in range(max(0, e - 20), e):
            i = ids.get(t[s:e])
            for gain, what in ([(p.scores[i], i)] if i is not None else []) + \
                    ([(p.unknown_score, -1)] if s == e - 1 else []):
                if best[s][0] + gain > best[e][0]:
                    best[e] = (best[s][0] + gain, s, what)
    out, e = [], len(t)
    while e:
        _, s, what = best[e]
        out.append([what] if what >= 0 else [int(p.byte_id[b]) for b in t[s:e].encode()])
        e = s
    return [x for part in reversed(out) for x in part]


def test_pieces(make_docs):
    p = pieces.Pieces.load(PIECES)
    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = {m.id_to_piece(i): i for i in range(m.get_piece_size())
           if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))}
    rows = [(i, t) for i, t in odd_rows() if t is None or len(t) < 6000]
    got = pieces.encode_decode(make_docs(rows), PIECES).collect()
    assert Counter((r["doc_id"], None if r["ids"] is None else tuple(r["ids"])) for r in got) == \
        Counter((i, None if t is None else tuple(viterbi(p, t, ids))) for i, t in rows)
    text = dict(rows)
    for r in got:
        want = text[r["doc_id"]]
        assert r["decoded"] == (want.replace(pieces.MARK, " ") if want else want)
        if want:
            assert r["decoded"] == m.decode(r["ids"]) and r["n_ids"] == len(r["ids"])
    assert pieces.encode_decode(make_docs([]), PIECES).collect() == []


def test_pieces_round_trip_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = pieces.encode_decode(docs, PIECES).collect()
    assert len(got) == len(text) and all(r["decoded"] == text[r["doc_id"]] for r in got)


def test_double_array_finds_its_keys_only():
    rng = random.Random(4)
    keys = sorted({bytes(rng.choices(range(256), k=rng.randint(1, 5))) for _ in range(3000)})
    t = pieces.DoubleArray([(k, i) for i, k in enumerate(keys)])

    def look(k):
        node = 0
        for b in k:
            to = int(t.base[node]) + b + 1
            if to >= len(t.check) or t.check[to] != node:
                return -1
            node = to
        return int(t.value[node])

    assert [look(k) for k in keys] == list(range(len(keys)))
    assert all(look(k + b"x") == -1 for k in keys[:500] if k + b"x" not in set(keys))


def test_span_hashes_by_running_sums():
    from unilake.llm import textkit

    data = np.random.default_rng(1).integers(0, 256, 600_000).astype(np.uint8)
    edges = np.array([0, 3, 3 + textkit._SEGMENT, 200_000, 200_001, 599_999])
    starts, ends = edges[:-1], edges[1:] - np.array([1, 0, 5, 0, 7])
    want = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):   # powers of one number, plainly
        total = 0
        for x in data[a:b].tolist()[::-1]:
            total = (total * textkit._P + x + 1) % (1 << 64)
        total = (total + (b - a) * int(textkit._POS[6])) % (1 << 64)
        want.append(int(textkit.mix64(np.array([total], dtype=np.uint64))[0]))
    assert textkit.span_hashes(data, starts, ends).tolist() == want


def test_chunk_of_units_needs_little_memory():
    import tracemalloc

    p = pieces.Pieces([pieces.MARK, *"abcdefgh", "ab", "abc", "cde", "fgh", "<unk>"], [-1.0] * 14, ["normal"] * 13 + ["unknown"])
    rng = np.random.default_rng(2)
    units = ["".join("abcdefghij"[k] for k in rng.integers(0, 10, 7)) for _ in range(40_000)]
    tracemalloc.start()
    ids, off = p.encode([" ".join(units)], {})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(off) == 2 and len(ids) == off[-1] > 40_000
    assert peak < 220 * 40_000 * 8   # bytes for each byte of text


def test_chunk_whose_units_are_all_known(make_docs):
    p, cache = pieces.Pieces.load(PIECES), {}
    texts = ["one more word, one more", "", "ß word"]
    first, again = p.encode(texts, cache), p.encode(texts, cache)
    assert len(first[0]) and all((a == b).all() for a, b in zip(first, again, strict=True))
    long = "some words that come again " * (pieces.CHUNK // 20)   # a chunk for each row
    rows = make_docs([(i, long) for i in range(3)]).coalesce(1)
    got = pieces.encode_decode(rows, PIECES).collect()
    assert [(r["doc_id"], r["decoded"] == long) for r in got] == [(0, True), (1, True), (2, True)]
    assert got[0]["ids"] == got[1]["ids"] == got[2]["ids"] == p.encode([long], {})[0].tolist()


def test_word_hashes_depend_on_the_spans_bytes_alone():
    rng = random.Random(3)
    words = ["".join(rng.choices("ab", k=rng.choice([1, 2, 7, 8, 9, 16, 17, 63, 64, 65, 200]))) for _ in range(2000)]
    data = np.frombuffer(" ".join(words).encode() + b" " * 8, dtype=np.uint8)
    starts, ends = textkit.word_spans(data, np.array([0, len(data)]), ~textkit.SPACE)
    of = {}
    for w, h in zip(words, textkit.word_hashes(data, starts, ends).tolist(), strict=True):
        assert of.setdefault(w, h) == h
    assert len(set(of.values())) == len(of)


@pytest.mark.parametrize("close", [False, True])
def test_sorted_sets_and_keys_that_share_their_first_bits(close):
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 3000).astype(np.uint64)[rng.integers(0, 3000, 9000)]
    if close:
        h = (h & np.uint64(31)) | np.uint64(1 << 63)
    owner, rank = rng.integers(0, 40, 9000), (h % np.uint64(3)).astype(np.uint16)
    for r in (rank, None):
        flat, off = textkit.sorted_sets(h, owner, 41, r)
        for k in range(41):
            own = {(0 if r is None else int(x % 3), int(x)) for x in h[owner == k].tolist()}
            assert flat[off[k]:off[k + 1]].tolist() == [x for _, x in sorted(own)]
    node, n = rng.integers(0, 50, 9000), rng.integers(1, 5, 9000)
    got = setkit._key_order(h, node, n)
    want = np.lexsort((node, n, h))
    for x in (h, n, node):
        assert (x[got] == x[want]).all()
