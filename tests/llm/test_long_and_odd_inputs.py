"""Long texts in pieces, naive Bayes by hand, other tokenizers, and the choice of labelled rows."""

import math
import random
import re
import sys
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulgrain.llm import language_id, quality_rules, shingle_hash, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")


def sets(texts):
    out = {}
    for first, values, offsets in shingle_hash.shingle_sets(pa.array(texts)):
        for k in range(len(offsets) - 1):
            out[first + k] = values[offsets[k]:offsets[k + 1]].tolist()
    return out


def test_shingles_of_long_texts_in_pieces(monkeypatch):
    r = random.Random(1)
    say = lambda n: "".join(r.choice(["Ab", "c", "é漢", "long" * 9]) + r.choice([" ", "\n", "  \t", "\r\n"]) for _ in range(n))
    texts = [say(400), "  " + say(300), "x" * 5000 + " " + say(60), say(200) + "y" * 3000, "z" * 4000, " " * 4000, say(3), "", None,
             "a b " * 900, "x" * 900 + " b"]
    whole = sets(texts)
    monkeypatch.setattr(shingle_hash, "CHUNK_BYTES", 256)
    monkeypatch.setattr(shingle_hash, "_powers", {})
    assert sets(texts) == whole
    assert all(len(x) <= 257 for x in shingle_hash._powers.values())
    for k in (0, 2, 3):
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[k].lower())
        assert len(whole[k]) == len({tuple(words[i:i + 5]) for i in range(len(words) - 4)})


def test_memory_of_a_long_text_is_a_few_times_its_size():
    import subprocess

    code = (
        "import resource, random, pyarrow as pa\n"
        "from haulgrain.llm import language_id, shingle_hash\n"
        "r = random.Random(1)\n"
        "words = [''.join(r.choice('abcdefgh') for _ in range(6)) for _ in range(50_000)]\n"
        "text = ' '.join(r.choice(words) for _ in range(5_000_000))\n"  # 35 MB
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "n = sum(len(v) for _, v, _ in shingle_hash.shingle_sets(pa.array([text])))\n"
        "one = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before\n"
        "m = sum(len(b) for _, _, b, _ in language_id.ngram_chunks([text]))\n"
        "print(n, m, one // 1024, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)\n")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 4_000_000 and int(out[1]) > 80_000_000
    assert int(out[2]) < 600 and int(out[3]) < 700  # MB


# --- naive Bayes -----------------------------------------------------------------------------

def grams(text):
    """Hashed n-grams that end in a letter, character by character."""
    chars = [ord(c) if c.isalpha() else 0 for c in (text or "").lower()]
    out = []
    for i, c in enumerate(chars):
        if not c:
            continue
        h = 0
        for k in range(3):
            before = chars[i - k] if i - k >= 0 else 0
            h = ((h ^ (before + k + 1)) * language_id._KEYS[k]) % 2 ** 32
            out.append((h ^ (h >> 15)) % language_id.BUCKETS)
    return out


def test_naive_bayes_by_hand(spark, monkeypatch):
    r = random.Random(2)
    letters = {"en": "etaoin shr", "fr": "esaitn rué", "ру": "оеаинт срв"}
    rows = [(i, "".join(r.choice(letters[g] + "xyz 1") for _ in range(r.randint(0, 60))), r.choice([g, g, g, None]))
            for i in range(150) for g in [r.choice(list(letters))]]
    rows += [(500, "ΑΣ ΣΑΣ " * 40, "fr"), (501, None, "fr"), (502, "", "en"), (None, "the teen", "en")]
    counts, texts, held = {}, Counter(), lambda k: k is not None and zlib.crc32(str(k).encode()) % 4 == 2
    for k, t, g in rows:
        if not held(k) and t is not None and g is not None:
            counts.setdefault(g, Counter()).update(grams(t))
            texts[g] += 1
    langs = sorted(texts)
    logs = {g: (lambda b, own=counts[g]: math.log((own[b] + 0.5) / (sum(own.values()) + 0.5 * language_id.BUCKETS))) for g in langs}
    want = []
    for k, t, _ in rows:
        own = grams(t)
        if not own:
            want.append((k, held(k), "und", 0.0))
            continue
        total = {g: math.log(texts[g] / sum(texts.values())) + sum(map(logs[g], own)) for g in langs}
        best = max(langs, key=lambda g: total[g])
        want.append((k, held(k), best, 1 / sum(math.exp(total[g] - total[best]) for g in langs)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)

    def check():
        got = sorted((tuple(x) for x in language_id.identify(frame).collect()), key=lambda x: str(x[:3]))
        assert [x[:3] for x in got] == sorted((x[:3] for x in want), key=str)
        for a, b in zip(got, sorted(want, key=lambda x: str(x[:3])), strict=True):
            assert a[3] == pytest.approx(b[3], abs=1e-9)

    check()
    assert sum(len(b) for _, _, b, _ in language_id.ngram_chunks([t for _, t, _ in rows])) == sum(len(grams(t)) for _, t, _ in rows)
    whole = [x[2].tolist() for x in language_id.ngram_chunks([t for _, t, _ in rows])]
    monkeypatch.setattr(language_id, "CHUNK", 7)  # every text in pieces
    assert sum([x[2].tolist() for x in language_id.ngram_chunks([t for _, t, _ in rows])], []) == sum(whole, [])


def test_a_column_of_other_values_is_no_language(spark):
    frame = spark.range(30).selectExpr("id AS doc_id", "'abc' AS text", "string(id) AS lang")
    with pytest.raises(ValueError, match="different values"):
        language_id.learn(frame, most=20)


# --- token files and labelled rows -----------------------------------------------------------

def test_other_tokenizers_get_whole_texts(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    texts = ["Ab ab AB", "two  spaces\nand a line, so", "don't DON'T", "", "x" * 5000 + " y"]
    for name, by_word in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        encoder, plain = token_files.WordEncoder(path), Tokenizer.from_file(path)
        assert encoder._by_word is by_word
        for _ in range(2):
            assert [x.tolist() for x in encoder(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    small = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), most=1000, longest=20)
    for t in texts * 2:
        assert small([t])[0].tolist() == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(t, add_special_tokens=False).ids
    assert small._held < 3000 and all(len(w) <= 20 for w in small._ids)


def test_the_labelled_rows_of_least_hash(spark):
    rows = spark.range(5000).selectExpr("if(id % 3 = 0, 7, id) AS id", "id AS word_chars", "id % 5 AS n_words").repartition(6)
    for most in (1, 100, 2000, 9999):
        want = rows.orderBy(F.xxhash64("id"), "id", "word_chars", "n_words").limit(most).collect()
        assert sorted(quality_rules._least_hashes(rows, most).collect()) == sorted(want)
    assert quality_rules._least_hashes(rows.limit(0), 10).count() == 0
