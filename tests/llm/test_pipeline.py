import random

import corpus_pipeline
from punctual.llm import mixing
from tests.llm import test_decontaminate, test_minhash, test_substring

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def world(tmp_path, spark):
    rng = random.Random(11)
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(2, 7)))
    text = lambda a, n: [word(a) for _ in range(n)]
    items = [(j, " ".join(text("abcdefgh", 30)), 0) for j in range(4)]
    passage, docs = text("abcdefgh", 60), []
    for i in range(150):
        a, lang = ("abcdefgh", "aa") if i % 3 else ("mnopqrst", "mm")
        own = text(a, rng.randint(20, 120))
        if i % 10 == 1:
            own[5:5] = passage
        if i % 25 == 4:
            own[3:3] = items[i % 4][1].split()
        docs.append([i, " ".join(own), lang, f"s{i % 4}", 0])
    docs += [[200 + i, docs[i][1] + " tail", docs[i][2], "copies", 0] for i in range(0, 40, 2)]
    docs += [[300, None, "aa", None, 0], [301, "", "aa", "s1", 0], [302, "12 34 !!", "mm", "s1", 0]]
    docs = [(i, t, lang, s, len(t or "")) for i, t, lang, s, _ in docs]
    for name, df in (("documents", spark.createDataFrame(docs, SCHEMA)), ("benchmark", spark.createDataFrame([r[:2] for r in items], "item_id long, text string"))):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return items


def test_each_stage_against_its_plain_version(spark, tmp_path):
    items, d = world(tmp_path, spark), str(tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted((tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in df.collect()), key=str)

    known = stages["language_id"](spark, docs, d).cache()
    assert known.columns == docs.columns
    assert {r[0] for r in rows(docs)} - {r[0] for r in rows(known)} == {300, 301, 302}

    single = stages["near_dedup"](spark, known, d).cache()
    kept = {i for i, (_, _, keep) in test_minhash.brute(rows(known)).items() if keep}
    assert single.columns == docs.columns and {r[0] for r in rows(single)} == kept and len(kept) < 160

    cut = stages["substring_dedup"](spark, single, d).cache()
    removed = {i: n for i, _, n, _ in test_substring.brute(rows(single))}
    assert cut.columns == docs.columns and any(removed.values())
    before = {r[0]: r for r in rows(single)}
    for i, text, *rest, n_chars in rows(cut):
        if removed[i]:
            assert len(text.split()) == len(before[i][1].split()) - removed[i] and n_chars == len(text)
        else:
            assert (text, *rest, n_chars) == before[i][1:]

    clean = stages["decontamination"](spark, cut, d).cache()
    dirty = {i for i, _ in test_decontaminate.brute(rows(cut), items)}
    assert clean.columns == docs.columns and dirty and {r[0] for r in rows(clean)} == {r[0] for r in rows(cut)} - dirty

    mixed = stages["mixing"](spark, clean, d)
    planned = {r.doc_id: r.copies for r in mixing.plan(clean).collect()}
    assert mixed.groupBy("doc_id").count().collect() and {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: n for i, n in planned.items() if n}


def test_run_applies_all_stages(spark, tmp_path):
    world(tmp_path, spark)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 50 and not {300, 301, 302} & {r.doc_id for r in out.select("doc_id").collect()}


ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, kept_text string, places long, copies array<int>, in_0 string"


def test_stages_bear_odd_rows_and_clashing_columns(spark, tmp_path):
    plain = " ".join(f"word{i}" for i in range(60))
    spark.createDataFrame([(1, "bench " * 10)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    tail = ("s", "t", 1, [1], "z")
    rows = [(1, plain, "aa", "s1", 1, *tail), (1, plain, "aa", "s1", 1, *tail), (None, plain, "aa", None, None, *tail), (None, "other words here", None, None, None, None, None, None, None, None), (2, None, None, None, None, *tail), (3, "", "aa", "s1", 0, *tail), (4, "x" * 100_000, "aa", "s1", 0, *tail), (5, "bench " * 10, "aa", "s2", 0, *tail), (6, "a b", "bb", "s2", 0, *tail)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, ODD)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path)).cache()
            ids = sorted((r.doc_id for r in out.collect()), key=str)
            assert set(docs.columns) <= set(out.columns)
            if name != "mixing":
                assert out.columns == docs.columns
            if given:
                want = {"language_id": [1, 1, 4, 5, 6, None, None], "near_dedup": [1, 2, 3, 4, 5, 6, None, None], "substring_dedup": [1, 1, 2, 3, 4, 5, 6, None, None], "decontamination": [1, 1, 2, 3, 4, 6, None, None]}
                assert name == "mixing" or ids == want[name]
            else:
                assert ids == []


def test_near_dedup_keeps_one_row_of_repeated_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(12)), " ".join(f"b{i}" for i in range(12))
    docs = spark.createDataFrame([(i, t, "aa", "s", 0) for i, t in [(3, a), (5, a), (5, b), (9, b), (12, "z"), (12, "y")]], SCHEMA)
    out = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(3, a), (12, "y")]
