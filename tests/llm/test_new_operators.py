"""Rank BPE, spelling variants and token alignment against plain versions."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
from clickloom.llm import rank_bpe, spelling, token_alignment
from clickloom.llm.bpe import byte_symbols

SF = "/root/testdata/sf0.01"
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = "<|endoftext|>"


def documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def by_id(name, spark):
    return {r.doc_id: r for r in entry.queries()[name](spark, SF).collect()}


# Rank BPE


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as file:
        return rank_bpe.codec(file.read(), public_tokenizers.PATTERN)


def test_rank_bpe_equals_the_library(spark, library):
    found = by_id("op11_rank_bpe", spark)
    texts = documents(spark)
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode_ordinary(text or "")
        listed = " ".join(map(str, ids)).encode()
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(listed).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_rank_bpe_cuts_at_safe_places(library, codec, monkeypatch):
    monkeypatch.setattr(rank_bpe, "PIECE", 7)
    monkeypatch.setattr(rank_bpe, "LONG_RUN", 3)
    monkeypatch.setattr(rank_bpe, "_RUN", rank_bpe.regex.compile(r"\p{White_Space}{4,}"))
    rng = random.Random(5)
    alphabet = "ab TH'sdtll,.!?19\n\t\r \x0b\x1c\x85  　é中。🙂٣"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert "".join(p for p, _ in rank_bpe.pieces(text)) == text
        assert codec.decode(ids) == text.encode()


def test_rank_bpe_of_long_runs(codec):
    """Runs of white space that stop the library itself."""
    for text in (" " * 400_000 + "x", "\n " * 200_000, "a" * 300_000, "w " * 200_000 + SPECIAL):
        ids = codec.encode(text)
        assert codec.decode(ids) == text.encode()
        assert 50256 not in ids
    assert codec.encode(" " * 1200 + "x") == codec.encode(" " * 1199) + codec.encode(" x")


def test_rank_bpe_ids_and_bytes(rows):
    frame = rows([(1, "héllo 🙂"), (2, None), (3, "")], "doc_id long, text string")
    ids = rank_bpe.encode(frame, RANKS, public_tokenizers.PATTERN)
    back = rank_bpe.decode(ids, RANKS, public_tokenizers.PATTERN)
    found = {r.doc_id: (r.ids, bytes(r.raw)) for r in back.collect()}
    assert found[1][1] == "héllo 🙂".encode() and len(found[1][0]) > 3
    assert found[2] == found[3] == ([], b"")


# Spelling variants


def plain_words(rows, one_in):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words):
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    near = {
        w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if one_apart(w, v)] for w in words
    }
    forms = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    forms = {w: f for w, f in forms.items() if words[f] >= 2 * words[w]}
    found = {}
    for w in words:
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        found[w] = (form, root, words[w], len(near[w]), words.get(form))
    return found


def as_found(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_spelling_query_equals_brute_force(spark):
    words = plain_words(documents(spark).items(), 97)
    assert len(words) > 5000
    found = as_found(entry.queries()["op12_spelling_variants"](spark, SF))
    assert found.keys() == words.keys()
    for w in sorted(words)[::40]:
        near = [v for v in words if one_apart(w, v)]
        assert found[w][2:4] == (words[w], len(near))
        best = min(near, key=lambda x: (-words[x], x), default=None)
        assert found[w][0] == (best if best and words[best] >= 2 * words[w] else None)


@pytest.mark.parametrize("share, longest", [(0.02, 3), (0.001, 4), (0.0, 5), (1.0, 2)])
def test_gram_lists_find_every_pair(monkeypatch, share, longest):
    """Words over few letters, where most grams are frequent and most edits affect many."""
    monkeypatch.setattr(spelling, "LONGEST", longest)
    rng = random.Random(longest)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(700)}
    grams = Counter(
        w[i : i + q] for w in words for q in range(2, longest + 1) for i in range(len(w) - q + 1)
    )
    kept = {g for g in grams if len(g) == 2 or grams[g[:-1]] > share * len(words)}
    index = spelling.GramIndex(kept)
    lists = {w: spelling.word_lists(index, w) for w in words}
    own = defaultdict(set)
    for w, (_, keys, _) in lists.items():
        for key in keys:
            own[key].add(w)
    for a in words:
        met = set().union(*(own[k] for k in lists[a][2]))
        for b in words:
            if one_apart(a, b) and b not in met:
                assert lists[a][0] and any(a in own[k] for k in lists[b][2]), (a, b)


def test_variants_of_made_words(rows):
    rng = random.Random(9)
    words = {}
    while len(words) < 600:
        words["".join(rng.choice("abcß×") for _ in range(rng.randint(5, 8)))] = rng.choice(
            [3, 4, 6, 6, 12, 25, 50, 100]
        )
    words |= {"chain" + "x" * i: 3 * 2**i for i in range(8)}  # each the form of the one before
    found = as_found(spelling.variants(rows(list(words.items()), "word string, n long")))
    assert found == plain_variants(words)
    assert found["chain"][1] == "chain" + "x" * 7


def test_spelling_edges(rows):
    text = "Straße straße STRAßE Straßen abcde ABCDE abcde naïve×s"
    data = [(1, text, 1), (1, text, 1), (None, text, 2), (2, None, 3), (3, "", 3), (4, "12 ??", 3)]
    frame = rows(data, "doc_id long, text string, word int")
    counts = spelling.word_counts(frame)
    # Upper-case letters beyond A-Z stay.
    assert {r.word: r.n for r in counts.collect()} == {
        "straße": 9, "straßen": 3, "abcde": 9, "naïve×s": 3
    }
    found = as_found(spelling.variants(counts))
    assert found["straßen"] == ("straße", "straße", 3, 1, 9)
    assert found["abcde"] == (None, "abcde", 9, 0, None)
    nothing = rows([], "doc_id long, text string")
    assert spelling.variants(spelling.word_counts(nothing)).count() == 0


# Token alignment


def plain_alignment(texts):
    a_model = Tokenizer.from_file(JSON)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    symbols = byte_symbols()

    def b_bytes(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    done, counts = {}, Counter()
    for i, text in texts.items():
        done[i] = None
        if not text:
            continue
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text, num_threads=1)
        a_raw = [bytes(symbols[c] for c in a_model.id_to_token(x)) for x in a]
        b_raw = [b_bytes(x) for x in b]
        if not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
            continue
        a_at, b_at = spans(a_raw), spans(b_raw)
        groups, pairs, low = [], [], 0
        for end in sorted({e for _, e in a_at} & {e for _, e in b_at}):
            left = [k for k, (s, e) in enumerate(a_at) if low <= s and e <= end]
            right = [k for k, (s, e) in enumerate(b_at) if low <= s and e <= end]
            groups.append(
                ",".join(str(a[k]) for k in left) + "|" + ",".join(str(b[k]) for k in right)
            )
            pairs += [
                (a[x], b[y])
                for x in left
                for y in right
                if a_at[x][0] < b_at[y][1] and b_at[y][0] < a_at[x][1]
            ]
            low = end
        done[i] = (len(a), len(b), groups, pairs)
        counts.update(pairs)
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    found = {}
    for i, one in done.items():
        if one is None:
            found[i] = (0, 0, 0, 0, 0, 0, "")
            continue
        n_a, n_b, groups, pairs = one
        best = sum(counts[p] == top[p[1]] for p in pairs)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        total = sum(counts[p] for p in pairs)
        found[i] = (n_a, n_b, len(groups), len(pairs), best, total, digest)
    return found


def as_alignment(frame):
    return {
        r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
        for r in frame.collect()
    }


def odd_texts():
    rng = random.Random(11)
    alphabet = "ab THé中🙂,.'s19\n\t\r \x0b\x1c\x85 　́"
    texts = {i: "".join(rng.choice(alphabet) for _ in range(50)) for i in range(300)}
    odd = ["", None, " ", "  lead", "tail  ", "\nline\n\n next", "a▁b", "x <s> </s> <unk> <0x41>"]
    odd += [SPECIAL, f"a {SPECIAL}b", "\0 nul", "ﬁ ligature", "a" * 3000, " " * 3000 + "x", "\r\n);\r"]
    return texts | {1000 + i: t for i, t in enumerate(odd)}


def test_alignment_query_equals_the_plain_version(spark):
    small = documents(spark)
    found = as_alignment(entry.queries()["op13_token_alignment"](spark, SF))
    assert found.keys() == small.keys()
    a_and_b = {i: v[:4] + v[6:] for i, v in found.items()}
    short = {i: t for i, t in small.items() if len(t or "") < 1500}
    plain = plain_alignment(short)
    assert all(a_and_b[i] == v[:4] + v[6:] for i, v in plain.items())
    # Every link of a document counts itself, and the best links are among all.
    assert all(v[5] >= v[3] >= v[4] >= 0 for v in found.values())


def test_alignment_of_odd_texts(rows):
    texts = odd_texts()
    frame = rows(list(texts.items()), "doc_id long, text string")
    found = as_alignment(token_alignment.align(frame.repartition(5), JSON, PIECES))
    assert found == plain_alignment(texts)
    assert found[1006] == (0, 0, 0, 0, 0, 0, "")


def test_alignment_edges(rows):
    data = [(1, "one two", 5), (1, "one two", 5), (None, "one", 6), (2, None, 7)]
    frame = rows(data, "doc_id long, text string, n_a int")
    found = token_alignment.align(frame, JSON, PIECES).collect()
    twice = [r for r in found if r.doc_id == 1]
    assert len(found) == 4 and twice[0] == twice[1] and twice[0].count_sum >= 4
    assert [r.n_links for r in found if r.doc_id == 2] == [0]
    assert token_alignment.align(frame.limit(0), JSON, PIECES).count() == 0
    groups = token_alignment.aligned_groups(frame, JSON, PIECES).filter("doc_id = 1").first().groups
    assert len(groups) == twice[0].n_groups
    assert sum(len(g.a) for g in groups) == twice[0].n_a


def test_alignment_of_many_segments_at_once():
    """A lot costs its own segments, not the block's; joined segments are aligned as alone."""

    class Unwalked(list):
        def __iter__(self):
            raise AssertionError("walks all segments of the block")

    with open(JSON, encoding="utf-8") as a, open(PIECES, "rb") as b:
        own = token_alignment.Aligner(a.read(), b.read())
    block = token_alignment._Block(0)
    block._segments = Unwalked()
    block.add([1], ["one two three"], own)
    block.add([2], ["two mispelllt wordz, ünd 中文"], own)
    assert len(block) == 2 and len(block._segments) == 7
    parts = [" mispelllt", " wordz,", " ünd", " 中文🙂x", " a", "\n\nnext", " x-1.5;qqzxj"]
    assert own._align_joined(parts) == own._align_alone(parts)
