"""The pipeline against a brute-force version of its stages, and the driver's entry."""

from __future__ import annotations

import importlib
import json
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from llm.conftest import prose
from llm.test_dedup import brute_spans, expected_components
from llm.test_mixing import brute_targets

ROOT = Path(__file__).resolve().parents[2]


def test_stages_decide_as_brute_force_does(documents, spark):
    shared = prose(700, 60)
    rows = [(i, prose(i, 40 + i), "en", f"s{i % 3}") for i in range(12)]
    rows += [(20, rows[3][1], "en", "s0"), (21, rows[4][1] + " more", "en", None)]
    rows += [(30 + i, f"{prose(60 + i, 30)} {shared} {prose(80 + i, 20)}", "en", "s1") for i in range(3)]
    rows += [(40, "12 34 !!", "en", "s2"), (41, None, "en", "s2"), (42, "", "en", "s1")]
    docs = documents(rows, "k1 n")
    state, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        state = stage(spark, state, "")
        assert state.columns == columns, name
    kept = {r.doc_id: r for r in state.collect()}

    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    component = expected_components([r[:2] for r in lettered])
    stay = [r for r in lettered if component[r[0]][1] == r[0]]
    text = {r[0]: r[1].split() for r in stay}
    for doc, start, n, *_ in brute_spans([r[:2] for r in stay]):
        text[doc][start : start + n] = [None] * n
    want = {i: [w for w in ws if w] for i, ws in text.items() if any(ws)}
    assert {i: r.text.split() for i, r in kept.items()} == want
    assert all(r.n_chars == len(r.text) for r in kept.values())

    mixed = corpus_pipeline.mix_sources(spark, state, "").collect()
    sizes = {}
    for r in kept.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for source, target in brute_targets(sizes).items():
        taken = sum(len(r.text.split()) for r in mixed if r.source == source)
        assert abs(taken - target) <= 0.2 * target + 30

    packed = corpus_pipeline.pack(spark, corpus_pipeline.mix_sources(spark, state, ""), "").collect()
    tokens = sum(r.length for r in packed)
    assert tokens == sum(len(r.ids) for r in packed)
    assert len({r.sequence_id for r in packed}) == len(packed)


def test_pipeline_over_given_tables(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(found) > 100 and all(r.length & (r.length - 1) == 0 for r in found)


def test_entry_works_without_this_subpackage(tmp_path):
    copy = tmp_path / "copy"
    copy.mkdir()
    (copy / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    package = copy / "cardwarden"
    package.mkdir()
    for part in (ROOT / "cardwarden").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (package / part.name).symlink_to(part)
    code = "import json, __spark_entry__ as e; print(json.dumps([len(e.queries()), len(e.oracle_sql())]))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    entry = importlib.import_module("__spark_entry__")
    n, m = json.loads(out.stdout)
    assert 0 < n < len(entry.queries()) and 0 < m < len(entry.oracle_sql())
    assert {f"op{i}_" for i in range(1, 11)} <= {x.partition("_")[0] + "_" for x in entry.queries()}


def test_nothing_else_imports_the_subpackage():
    for path in [*(ROOT / "cardwarden").rglob("*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert "cardwarden.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()
