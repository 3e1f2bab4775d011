import re
from collections import Counter

import pytest
from corpus import SCHEMA, corpus, sentence
from pyspark.sql import functions as F
from random import Random

from tessella.llm import quality_rules as R


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_base(spark):
    rows = corpus(5) + [(500 + k, " ".join(Random(k).choice("abc") for _ in range(60)) + " # | $", "en", "s", 1) for k in range(10)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", words int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in R.measure(df).collect()}
    assert got == {r[0]: base(r[1]) for r in rows}


@pytest.mark.parametrize("bits", [21, 61, 5])
def test_windows_by_any_part_of_their_hash(spark, bits):
    """Few bits of hash, so that unlike windows meet; few places, so that texts have more windows."""
    rng = Random(bits)
    rows = [(k, [rng.choice("abcdefg") for _ in range(rng.randint(0, 200))]) for k in range(60)]
    got = {r.doc_id: r.n_repeat_words for r in R.repeat_words(spark.createDataFrame(rows, "doc_id long, words array<string>"), bits).collect()}
    assert got == {k: base(" ".join(words))[4] for k, words in rows}


def test_hosts(spark):
    """Copies are documents of their own; a null source and the source U+0000 are two hosts."""
    rng = Random(2)
    same = sentence(rng, 80)
    rows = [(k, same if k < 200 else sentence(rng, 80), "en", "h", 1) for k in range(250)]
    rows += [(300 + k, sentence(rng, 60) + "\nShared line here", "en", [None, "\0", "n"][k % 3], 1) for k in range(45)]
    measured = R.measure(spark.createDataFrame(rows, SCHEMA)).cache()
    assert [(r.host, r.docs) for r in R.frequent_lines(measured).collect()] == [("sh", 200)]
    assert sorted(r.docs for r in R.frequent_lines(measured, least=14).where("host <> 'sh'").collect()) == [15, 15, 15]
    assert sorted(r.doc_id for r in R.verdicts(measured).where("kept").collect()) == [*range(200, 250), *range(300, 345)]


def test_line_limits(spark):
    rng = Random(1)
    boiler = "\n".join(sentence(rng, 30) for _ in range(2))
    rows = [(k, sentence(rng, 80) + "\nCommon  Line of the site", "en", "h" if k < 60 else None, 1) for k in range(90)]
    rows += [(100 + k, boiler + "\n" + sentence(rng, 20), "en", "h", 1) for k in range(30)]
    rows += [(200, rows[0][1], "en", "h", 1)] * 40  # rows that repeat a document count once
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in R.verdicts(R.measure(df)).collect()}
    assert all(got[k].kept and got[k].removed_words == 5 for k in range(60)) and all(got[k].kept and got[k].removed_words == 5 for k in range(60, 90))
    assert all(not got[100 + k].kept and not got[100 + k].base_failed for k in range(30))
    assert got[200].kept
    out = {r.doc_id: r.text for r in R.apply_rules(df).collect()}
    assert sorted(out) == [*range(90), 200] and "Common" not in out[3] and out[3] in rows[3][1]
    clash = df.withColumns({n: F.lit("z") for n in ("_id", "_s2", "_k2", "_doc", "_left", "_removed", "_host", "words", "kept", "_text_key")})
    assert R.apply_rules(clash).columns == clash.columns and {r.doc_id: r.text for r in R.apply_rules(clash).collect()} == out
    assert R.apply_rules(df.limit(0)).count() == 0 and R.apply_rules(df).columns == df.columns
