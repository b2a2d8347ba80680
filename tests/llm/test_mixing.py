import duckdb
import pytest

from qualmart.llm.mixing import SQL, mix, mixed_documents


def rows_of(df):
    cols = ["row.doc_id", "size", "source_size", "target", "taken"]
    return sorted(df.select(*cols).collect(), key=str)


def oracle(docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    return sorted([tuple(None if x != x else x for x in r) for r in con.execute(SQL).fetchall()], key=str)


def test_matches_sql_on_odd_rows_and_hot_source(make, odd_texts):
    rows = [(i, t, "hot" if i % 3 else None) for i, t in enumerate(odd_texts)]
    rows += [(1000 + i, "w " * (i % 17), ["hot", "b", "c", "", "é"][i % 5 if i % 3 else 0]) for i in range(300)]
    rows += rows[5:8]
    docs = make(rows, extra=["size", "target", "Row", "src"])
    got = rows_of(mix(docs))
    assert [tuple(r) for r in got] == [(*r[:3], pytest.approx(r[3]), r[4]) for r in oracle(docs)]
    assert all(0 <= r.taken <= 3 * r.size for r in got)


def test_targets_share_all_words_and_are_met(make):
    docs = make([(i, "w " * 10, s) for i, s in enumerate("a" * 10 + "b" * 400 + "c" * 400)])
    got = rows_of(mix(docs))
    by = {}
    for r in got:
        t = by.setdefault(r.target, [0, r.source_size])
        t[0] += r.taken
    assert sum(by) == pytest.approx(8100)
    assert all(taken == int(target) and target <= 3 * size for target, (taken, size) in by.items())
    assert min(by) == 300  # weight 5, but the smallest source stops at 3 epochs


def test_empty_table_and_reruns(make, spark):
    assert mix(make([])).count() == 0
    docs = make([(i, "x " * (i % 9), "ab"[i % 2]) for i in range(200)])
    assert rows_of(mix(docs)) == rows_of(mix(docs.repartition(7)))


def test_training_rows_repeat_by_epoch(make):
    docs = make([(i, "w " * 10, s) for i, s in enumerate("a" * 4 + "b" * 40)], extra=["mix"])
    out = mixed_documents(docs)
    assert out.columns == [*docs.columns, "mix_"]
    got = out.select("doc_id", "mix_.*").collect()
    assert len([r for r in got if r.doc_id == 0]) == 3
    assert sum(r.taken for r in got) == sum(r.taken for r in mix(docs).collect())


def test_rows_without_ids_are_told_apart_by_their_texts(make):
    rows = [(None, f"text number {i}", "a") for i in range(300)] + [(5, f"again {i} " * 3, "b") for i in range(60)]
    rows += [(1000 + i, "w " * 40, "c") for i in range(40)]
    taken = []
    for parts in (1, 3, 7):
        out = mixed_documents(make(rows).repartition(parts))
        taken.append(sorted((str(r.doc_id), r.text, r.mix.epoch, r.mix.taken) for r in out.collect()))
    assert taken[0] == taken[1] == taken[2]
    docs = make(rows)
    assert [tuple(r) for r in rows_of(mix(docs))] == [(*r[:3], pytest.approx(r[3]), r[4]) for r in oracle(docs)]


def test_whole_documents_are_not_shuffled(make, spark):
    docs = make([(i, f"some words {i}", "ab"[i % 2]) for i in range(400)])
    plan = mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    # one window: that of the chunks at the cuts, below a filter on the chunk
    assert plan.count("Window ") == 1


def test_one_huge_document_at_the_cut(make):
    docs = make([(1, "w " * 50_000, "a")] + [(i, "x y", "b") for i in range(2, 300)] + [(400, None, "d")])
    assert [tuple(r) for r in rows_of(mix(docs))] == [(*r[:3], pytest.approx(r[3]), r[4]) for r in oracle(docs)]
