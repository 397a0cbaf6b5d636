"""The pipeline against a plain version of its stages, and that the rest works without the subpackage."""

import random
import subprocess
import sys
from pathlib import Path

from test_near_dedup import plain_components

import corpus_pipeline as cp
from aerostrata.llm import catalog, toxicity

ROOT = Path(__file__).resolve().parents[2]


def corpus():
    rng = random.Random(9)
    words = ["the", "thing", "with", "nation", "house", "being", "there", "would", "tree", "river", "stone", "cloud"]
    rows, labels = [], []
    for i in range(300):
        text = " ".join(rng.choices(words, k=rng.randrange(5, 60)))
        toxic = i % 5 == 0
        rows.append((i, text + (" stupid idiot" if toxic else "")))
        labels.append((i, 1, int(toxic)))
    for k in range(20):  # copies and near copies of longer texts
        base = [f"w{k}x{rng.randrange(300)}" for _ in range(80)]
        for edits in (0, 0, 1, 2, 30):
            text = list(base)
            for _ in range(edits):
                text[rng.randrange(80)] = f"new{rng.randrange(9999)}"
            rows.append((1000 + len(rows), " ".join(text)))
    rows += [(5000, None), (5001, ""), (5002, "12 345 !"), (5003, "word " * 20_000), (5005, "word " * 20_000)]
    return rows, labels


def write(spark, folder, rows, labels):
    docs = [(i, t, "en", "s", len(t or ""), "x") for i, t in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_and_their_columns():
    assert [name for name, _ in cp.STAGES] == ["toxicity", "language_id", "exact_dedup", "near_dedup", "packing"]


def test_run_equals_a_plain_version(spark, tmp_path):
    rows, labels = corpus()
    write(spark, tmp_path, rows, labels)
    docs, marks = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, marks)
    kept = [(i, t) for i, t in rows if model([t or ""])[0] < 0.5]
    assert not {0, 5} & {i for i, _ in kept} and len(kept) > 300
    kept = [(i, t) for i, t in kept if any(c.isalpha() for c in t or "")]
    last = {}
    for i, t in kept:
        last[t] = max(i, last.get(t, i))
    kept = [(i, t) for i, t in kept if last[t] == i]
    kept = sorted({c for _, _, c in plain_components(kept)})
    found = cp.run(spark, str(tmp_path)).collect()
    assert sorted({r.doc_id for r in found}) == kept
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)
    docs_out = docs
    for name, stage in cp.STAGES[:-1]:
        docs_out = stage(spark, docs_out, str(tmp_path))
        assert docs_out.schema == docs.schema, name


def test_run_on_an_empty_table(spark, tmp_path):
    rows, labels = corpus()
    docs = [(i, t, "en", "s", 0, "x") for i, t in rows[:1]]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string"
    spark.createDataFrame(docs, schema).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    names = [n.split("_")[0] for n in catalog.registered()]
    assert names == [f"op{k}" for k in range(1, 14)]
    assert catalog.oracle_queries().keys() <= catalog.registered().keys()


def test_the_rest_imports_without_the_subpackage(tmp_path):
    (tmp_path / "aerostrata").mkdir()
    for part in (ROOT / "aerostrata").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "aerostrata" / part.name).symlink_to(part)
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'hourly_run' in q and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
