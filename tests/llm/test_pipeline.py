"""Each stage of the pipeline on its own input, and the whole run."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cinesift import scratch_mark
from cinesift.llm import bpe, decontam, line_dedup, simhash, toxicity
from cinesift.llm.common import DOCUMENT_COLUMNS
from .test_line_dedup import brute as brute_lines
from .test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def corpus(spark, make_docs, tmp_path_factory):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(900)]

    def words(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, words(22)) for i in range(8)]
    rows, labels, toxic, leaked = [], [], set(), set()
    for i in range(240):
        text = words(rng.randint(30, 90)) + "\n" + words(20)
        if i % 6 == 0:
            parts = text.split(" ")
            for _ in range(4):
                parts.insert(rng.randrange(len(parts)), rng.choice(["vexxard", "gromblik"]))
            text, _ = " ".join(parts), toxic.add(i)
        if i % 6 == 1 and i % 4 == 1:
            # within a line of its own words: as a line it would be boilerplate of its source
            text, _ = f"{text}\n{words(5)} {items[i % 8][1]} {words(12)}", leaked.add(i)
        if i % 2:
            text += "\nread more on our site"
        rows.append((i, text, f"s{i % 3}"))
        if i % 3:
            labels.append((i, 1, int(i in toxic)))
    rows += [(500 + i, rows[2][1], "s1") for i in range(30)] + [(600, rows[3][1] + " end", "s0"), (601, "", "s0"), (602, "", "s1"), (603, None, "s1")]
    labels += [(i, 1, 1) for i in toxic if i % 2 == 0]
    where = str(tmp_path_factory.mktemp("tables"))
    make_docs(rows).write.parquet(f"file://{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{where}/benchmark.parquet")
    return f"file://{where}", toxic, leaked


def as_rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_stages_one_by_one(spark, corpus):
    where, toxic, leaked = corpus
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "decontamination", "bpe"]
    docs = spark.read.parquet(f"{where}/documents.parquet")

    clean = stages["toxicity"](spark, docs, where)
    assert tuple(clean.columns) == DOCUMENT_COLUMNS
    before, after = as_rows(docs), as_rows(clean)
    gone = {r[0] for r in before} - {r[0] for r in after}
    assert len(gone ^ toxic) <= 2

    lean = stages["line_dedup"](spark, clean, where)
    assert tuple(lean.columns) == DOCUMENT_COLUMNS
    assert sorted((r.doc_id, str(r.text)) for r in lean.collect()) == sorted((r[0], str(r[1])) for r in brute_lines(after))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lean.collect())
    assert not any("read more on our site" in (r.text or "").split("\n") for r in lean.collect())

    single = stages["simhash"](spark, lean, where)
    assert tuple(single.columns) == DOCUMENT_COLUMNS
    groups = brute_components({i: brute_fingerprint(t or "") for i, t, _ in as_rows(lean)})
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values()))
    # of the copies on one source one stays, with its text
    copies = {2, *range(500, 530)} & {r[0] for r in after}
    assert [r.text for r in single.collect() if r.doc_id in copies] == [next(t for i, t, _ in before if i == 2)]

    fair = stages["decontamination"](spark, single, where)
    assert tuple(fair.columns) == DOCUMENT_COLUMNS
    assert {r[0] for r in as_rows(single)} - {r[0] for r in as_rows(fair)} == leaked & {r[0] for r in as_rows(single)}

    last = stages["bpe"](spark, fair, where).collect()
    library = Tokenizer.from_file(bpe.default_tokenizer())
    texts = {i: t or "" for i, t, _ in as_rows(fair)}
    assert {r.doc_id: r.n_tokens for r in last} == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}

    mark = scratch_mark(spark)
    whole = corpus_pipeline.run(spark, where).collect()
    assert scratch_mark(spark) == mark + 1  # of what the stages wrote only the last one's output is left
    assert sorted(map(tuple, whole)) == sorted(map(tuple, last))


def test_every_stage_takes_an_empty_table(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus[0]).collect() == []


def test_each_stage_calls_its_operator():
    assert corpus_pipeline.ORACLE_SQL is None
    used = {bpe, decontam, line_dedup, simhash, toxicity}
    assert used == {getattr(corpus_pipeline, m.__name__.rpartition(".")[2]) for m in used}


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names}
