import re

from corpus import SCHEMA, corpus, text
from pyspark.sql import functions as F
from random import Random

from tessella.llm import line_dedup as L


def brute(rows, need):
    """Lines to keep of each row, by a scan over all windows in order."""
    words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x))
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x.strip(" \t\n\x0b\x0c\r")).lower()
    docs = []
    for doc_id, t in rows:
        parts = (t or "").split("\n")
        docs.append((doc_id, parts, [(i, norm(x), words(x)) for i, x in enumerate(parts) if words(x)]))
    first, gone = {}, {d[0]: set() for d in docs}
    for doc_id, _, lines in docs:
        for k in range(len(lines)):
            total, j = 0, k
            while j < len(lines) and total < need:
                total += lines[j][2]
                j += 1
            if total < need:
                break
            key = tuple(x[1] for x in lines[k:j])
            after, room = [], 0
            for x in lines[j:]:
                if room >= need:
                    break
                after.append(x)
                room += x[2]
            if key not in first:
                first[key] = [x[1] for x in after]
                continue
            last = lines[j - 1][0]
            for x, y in zip(after, first[key]):
                if x[1] != y:
                    break
                last = x[0]
            gone[doc_id] |= set(range(lines[k][0], last + 1))
    return {d[0]: "\n".join(x for i, x in enumerate(d[1]) if i not in gone[d[0]]) for d in docs}


def test_brute_force(spark):
    rng = Random(9)
    rows = corpus(9, 30)
    shared = text(rng, 5, 15)
    rows += [(300 + k, text(rng, 2, 12) + "\n" + shared + f"\n{text(rng, 1, 10)}\n\n" + "\n".join(shared.split("\n")[k % 4 :]), "en", "s", 1) for k in range(8)]
    df = spark.createDataFrame(rows, SCHEMA)
    for need in (50, 20):
        got = {r.doc.doc_id: r.kept_text or "" for r in L.with_runs(df, need).collect()}
        assert got == brute([(r[0], r[1]) for r in rows], need)
    out = L.dedup_lines(df.withColumnRenamed("lang", "runs").withColumnRenamed("source", "k1").withColumn("doc", F.lit(1)).withColumn("kept_text", F.lit("a")))
    assert out.columns == ["doc_id", "text", "runs", "k1", "n_chars", "doc", "kept_text"] and {r.k1 for r in out.collect()} == {r[3] for r in rows}
    want = brute([(r[0], r[1]) for r in rows], 50)
    assert sorted(r.doc_id for r in out.collect()) == [r[0] for r in rows if want[r[0]].split() or want[r[0]] == (r[1] or "")]
    assert L.dedup_lines(df.limit(0)).count() == 0
