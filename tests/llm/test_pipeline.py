from __future__ import annotations

import os
import random

import pytest

import corpus_pipeline
from starlane.session import materialize, scratch, shared_folder
from tests.llm.helpers import alnum_words
from tests.llm.test_jaccard_join import plain as plain_components
from tests.llm.test_packing import check

PROSE = [a + b for a in ("ba", "ko", "li", "mu", "ne", "ta") for b in ("ra", "st", "vi", "x", "do", "pe", "n")]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder_of(spark, tmp_path_factory):
    rng = random.Random(8)
    folder = str(tmp_path_factory.mktemp("tables"))

    def prose(n):
        return " ".join(rng.choices(PROSE, k=n))

    item = prose(14)
    texts = [prose(rng.randint(25, 150)) for _ in range(120)]
    texts += [" ".join(w + "$#%" for w in prose(60).split()) for _ in range(60)]
    texts += [t + " end" for t in texts[:10]] + texts[10:15]
    texts += [prose(40) + " " + item + " " + prose(40), prose(40) + f" a.b{3}@mail.org " + prose(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(500, None, "en", "s", None), (501, "", None, None, 0), (7, texts[7], "en", "s", 1), (None, prose(50), "en", "s", 1)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, int(i < 120), 0) for i in range(180)]
    spark.createDataFrame(marks, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_do_what_they_decide(spark, folder_of):
    docs = spark.read.parquet(f"{folder_of}/documents.parquet")
    after = [docs]
    for name, stage in corpus_pipeline.STAGES:
        after.append(materialize(stage(spark, after[-1], folder_of), "test-stage"))
    for frame in after[1:-1]:
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
    rows = [sorted(f.collect(), key=repr) for f in after]
    by_id = [{r.doc_id: r for r in x if r.doc_id is not None} for x in rows[:-1]]
    # Junk goes, prose stays.
    assert set(range(120)) <= set(by_id[1]) and not set(range(120, 180)) & set(by_id[1])
    # One of each group of near copies, by all pairs.
    good = sorted((r for r in rows[1] if r.doc_id is not None), key=lambda r: r.doc_id)
    groups = plain_components([r.text for r in good], 5, 80)
    want = {good[root].doc_id if size else r.doc_id for r, (size, root) in zip(good, groups)}
    assert set(by_id[2]) == want and sum(r.doc_id == 7 for r in rows[2]) == 1
    assert sum(r.doc_id is None for r in rows[2]) == sum(r.doc_id is None for r in rows[1])
    # What holds the item goes.
    item = alnum_words(spark.read.parquet(f"{folder_of}/benchmark.parquet").first().text)
    holds = {i for i, r in by_id[2].items() if any(
        item[k : k + 10] == alnum_words(r.text)[j : j + 10]
        for k in range(len(item) - 9) for j in range(len(alnum_words(r.text)) - 9))}
    assert set(by_id[2]) - set(by_id[3]) == holds and holds
    # Nobody goes for personal data; what is replaced is.
    assert set(by_id[4]) == set(by_id[3])
    changed = [i for i in by_id[4] if by_id[4][i].text != by_id[3][i].text]
    assert [by_id[4][i].text.count("[EMAIL]") for i in changed] == [1]
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows[4])
    # All that is left is packed.
    kept = [r for r in rows[4] if r.doc_id is not None]
    number = {r.doc_id: k for k, r in enumerate(kept)}
    pieces = [r for r in rows[5] if r.doc_id is not None]
    tokens = sum(r.doc_tokens for r in rows[5] if r.start == 0)
    assert sum(r.length for r in rows[5]) == tokens and len(number) == len({r.doc_id for r in pieces})


def test_stages_decide_by_row(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(rng.choices(PROSE, k=60)) for _ in range(6)]
    item = " ".join(rng.choices(PROSE, k=14))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # Row 5 is a near copy of row 1; other rows with id 5 hold texts of their own.
    rows = [(1, texts[0]), (5, texts[0] + " end"), (5, texts[1]), (5, texts[2]), (5, texts[2]), (None, texts[3]),
            (None, texts[3] + " end"), (None, texts[1]), (None, None), (None, ""), (6, texts[4] + " " + item),
            (6, texts[5]), (None, texts[4] + " " + item + " x y z " + texts[5])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)
    docs = materialize(docs, "test-rows")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()]
    nulls = [t for i, t in kept if i is None]
    assert sorted(x for x in kept if x[0] is not None) == sorted([rows[0], rows[2], rows[3], rows[10], rows[11]])
    assert len(nulls) == 4 and None in nulls and "" in nulls and rows[12][1] in nulls
    clean = [(r.doc_id, r.text) for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()]
    assert sorted(clean, key=repr) == sorted((x for x in rows if item not in (x[1] or "")), key=repr)


def test_run_joins_the_stages(spark, folder_of):
    out = corpus_pipeline.run(spark, folder_of).collect()
    ends = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096 and check is not None


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", COLUMNS), ("labels", "doc_id long, quality long, toxic long"),
                         ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_with_names_of_the_stages(spark, folder_of):
    """Columns that are called like inner ones keep their values."""
    docs = spark.read.parquet(f"{folder_of}/documents.parquet")
    extra = ("same", "SAME_", "row", "body", "score", "label", "blank", "rank", "length", "comp", "block", "hits")
    wide = docs.where("n_chars > 0").selectExpr("*", *[f"doc_id * 7 + {k} AS {c}" for k, c in enumerate(extra)])
    wide = materialize(wide, "test-wide")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = materialize(stage(spark, wide, folder_of), "test-wide-stage")
        assert out.columns == wide.columns, name
        for r in out.collect():
            assert r.doc_id is None or [r[c] for c in extra] == [r.doc_id * 7 + k for k in range(len(extra))], name
    no_length = wide.drop("n_chars")
    assert corpus_pipeline.personal_data(spark, no_length, folder_of).columns == no_length.columns


def written(spark):
    """Tables in the shared folder."""
    folder = shared_folder(spark).removeprefix("file:") + "/starlane"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_scratch_deletes_all_but_what_is_kept(spark):
    before = written(spark)
    with scratch(spark) as keep:
        first = materialize(spark.range(5), "test-first")
        with scratch(spark) as pass_on:
            second = materialize(first.where("id > 1"), "test-second")
            third = pass_on(second.where("id > 2"), "test-third")
        assert {x.rsplit("-", 1)[0] for x in written(spark) - before} == {"test-first", "test-third"}
        last = keep(first.join(third, "id"), "test-last")
    assert sorted(r.id for r in last.collect()) == [3, 4]
    with pytest.raises(ZeroDivisionError), scratch(spark):
        materialize(spark.range(5), "test-first")
        raise ZeroDivisionError
    materialize(spark.range(5), "test-outside")
    assert {x.rsplit("-", 1)[0] for x in written(spark) - before} == {"test-last", "test-outside"}


def test_stages_leave_only_what_their_output_reads(spark, folder_of):
    """Tables as large as the texts do not stay until the last stage."""
    docs = spark.read.parquet(f"{folder_of}/documents.parquet")
    before = written(spark)
    good = corpus_pipeline.quality(spark, docs, folder_of)
    assert written(spark) == before
    one = corpus_pipeline.near_duplicates(spark, good, folder_of)
    left = {x.rsplit("-", 1)[0] for x in written(spark) - before}
    assert left == {"near-duplicates", "near-copies", "repeated-rows"}
    assert 0 < one.count() < good.count()
