import random

import corpus_pipeline as C
from qualmart.llm.queries import ORACLE_SQL, QUERIES


def words(rng, n):
    return " ".join(rng.choice("abcdefgh") + rng.choice("xyzuvw") + str(rng.randrange(30)) for _ in range(n))


def test_planted_cases(make, spark, tmp_path):
    rng = random.Random(9)
    docs = [(i, words(rng, 120), f"s{i % 3}") for i in range(60)]
    clean = dict((i, t) for i, t, _ in docs)
    item = words(rng, 30)
    docs += [(100, docs[0][1], "s0"), (101, docs[0][1] + " extra", "s1"), (0, docs[0][1], "s0")]  # copies
    docs += [(200 + i, " ".join(x + "##" for x in words(rng, 100).split()), "s1") for i in range(40)]  # junk
    docs += [(300, f"{words(rng, 60)} {item} {words(rng, 60)}", "s2"), (301, words(rng, 70) + " 10.1.2.3", "s2")]
    docs += [(400, None, None), (401, "", "s0")]
    make(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(not 200 <= i < 300), 0) for i, _, _ in docs], "doc_id long, quality int, toxic int") \
         .write.parquet(f"{tmp_path}/labels.parquet")
    columns, at = None, spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = {}
    for name, stage in C.STAGES:
        out = stage(spark, at, str(tmp_path))
        columns = columns or out.columns
        if name != C.STAGES[-1][0]:
            assert out.columns == columns == at.columns
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = sorted(r.doc_id for r in at.select("doc_id").collect())
    kept = [*range(60), 300, 301]
    assert ids["quality_rules"] == sorted([0, *kept, 100, 101])
    assert [i for i in ids["simhash_dedup"] if i != 101] == kept  # 101 may differ in more bits
    assert ids["decontamination"] == ids["simhash_dedup"]
    final = at.collect()
    texts = {r.doc_id: r.text for r in final}
    assert all(texts.get(i, t) == t for i, t in clean.items())
    assert item.split()[0] + " " + item.split()[1] not in texts.get(300, "") and "10.1.2.3" not in texts.get(301, "")
    assert all(0 < r.mix.taken <= r.mix.size and r.mix.epoch <= 3 for r in final)
    assert sorted(map(str, C.run(spark, str(tmp_path)).collect())) == sorted(map(str, final))


def test_repeated_and_null_ids_stay_once(make, spark):
    out = C.simhash_dedup(spark, make([(None, "a b c"), (None, "a b c"), (2, "x y z w"), (2, "x y z w"), (3, "x y z w")]), "")
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "None"]


def test_null_and_repeated_ids_with_different_texts(make, spark):
    rng = random.Random(3)
    a, b, c, d, e = (words(rng, 80) for _ in range(5))

    def kept(rows):
        return sorted(((r.doc_id, r.text) for r in C.simhash_dedup(spark, make(rows, extra=["fp"]), "").collect()), key=str)
    assert kept([(None, a), (None, b), (None, c), (None, c), (1, d)]) == sorted([(None, a), (None, b), (None, c), (1, d)], key=str)
    assert kept([(None, a), (None, b), (2, b), (2, b)]) == sorted([(None, a), (2, b)], key=str)
    assert kept([(1, a), (2, a), (2, b)]) == [(1, a), (2, b)]
    assert kept([(2, a), (2, b), (2, b), (3, b), (3, c), (4, e)]) == sorted([(2, a), (2, b), (3, c), (4, e)], key=str)
    assert len(kept([(None, None), (None, ""), (5, a)])) == 2


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES) and len(C.STAGES) == 5
