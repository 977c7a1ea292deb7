"""Runs over folders of markdown: first, unchanged, changed; errors; the command line."""

import json
from datetime import UTC, datetime

import pytest

from kgspark import cli
from kgspark.operators import graph
from kgspark.plans import corpus_run, ingest
from kgspark.sources.graph_store import GraphStore

BODY = "Person:{0} -WORKS_AT-> Organization:{1}\nPerson:{0} -LOCATED_IN-> Location:{2}"


def write(base, files):
    for name, text in files.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def at(second):
    return datetime(2026, 4, 27, 10, 0, second, tzinfo=UTC)


def tables(store):
    held = store.current()
    strip = lambda rows: sorted((tuple(r) for r in rows.collect()), key=str)
    e, f = held.table("entities"), held.table("edges")
    return strip(e.select(*sorted(e.columns))), strip(f.select(*sorted(f.columns)))


def test_runs_over_folders(spark, tmp_path):
    calls = str(tmp_path / "calls")

    class Counting(ingest.RuleBackend):
        def call(self, message):
            with open(calls, "a") as f:
                f.write("x")
            return ingest.RuleBackend.call(self, message)

    flat, nested, home = tmp_path / "fl+at (1)", tmp_path / "nested", str(tmp_path / "home")
    write(flat, {"A__B.md": "---\ntitle: First\n---\n" + BODY.format("Ann", "Acme", "Rome"), "A__C.md": BODY.format("Bob", "Acme", "Oslo"), "bad____name.md": "text", "empty.md": "  "})
    write(nested, {"x/y z.md": BODY.format("Ann", "Bell", "Rome"), "x/é+1.md": BODY.format("Cid", "Bell", "Oslo"), "x/note.txt": "no"})
    sources = [(str(flat), "corpus-a", "flat"), (str(nested), "corpus-b", "nested"), (str(tmp_path / "gone"), "corpus-c", "nested")]
    run = lambda second, prompt="v0": corpus_run.ingest_folders(spark, sources, home, Counting, prompt, now=at(second))
    first = run(1)
    assert (first["docs_canonicalized"], first["docs_failed"], first["docs_new"], first["chunks_extracted"]) == (4, 3, 4, 4)
    assert [m.split(": ")[1] for m in first["canonicalization_errors"]] == ["no such folder", "empty path segment", "empty body"]
    store = GraphStore(spark, home)
    docs = {r["canonical_path"]: (r["title"], r["source_path"]) for r in store.current().table("documents").collect()}
    assert docs == {"corpus-a/A/B": ("First", "A__B.md"), "corpus-a/A/C": ("C", "A__C.md"), "corpus-b/x/y z": ("y z", "x/y z.md"), "corpus-b/x/é+1": ("é+1", "x/é+1.md")}
    assert json.loads(store.files.read("runs/20260427T100001Z/report.json")) == first
    again = run(2)
    assert (again["docs_unchanged"], again["chunks_total"], again["entities_created"]) == (4, 0, 0) and len(open(calls).read()) == 4
    write(flat, {"A__C.md": BODY.format("Bob", "Bell", "Paris")})
    (nested / "x/y z.md").unlink()
    write(nested, {"x/new.md": BODY.format("Dee", "Acme", "Rome")})
    third = run(3)
    assert (third["docs_new"], third["docs_changed"], third["docs_deleted"], third["docs_unchanged"]) == (1, 1, 1, 2) and len(open(calls).read()) == 6
    assert store.versions() == ["graph-v20260427100001", "graph-v20260427100002", "graph-v20260427100003"]
    kept = store.current()
    built = graph.entities(kept.table("entity_facts")), graph.edges(kept.table("relation_facts"))
    whole = [sorted((tuple(r) for r in t.select(*sorted(t.columns)).collect()), key=str) for t in built]
    assert list(tables(store)) == whole
    other = str(tmp_path / "other")
    corpus_run.ingest_folders(spark, sources, other, ingest.RuleBackend, now=at(4))
    assert tables(GraphStore(spark, other)) == tables(store)  # as if it had all been taken in at once
    assert run(5, "v1")["chunks_extracted"] == 4  # another prompt asks for all again
    with pytest.raises(FileNotFoundError):
        corpus_run.ingest_folders(spark, sources[2:], home, Counting)
    with pytest.raises(ValueError):
        corpus_run.ingest_folders(spark, [], home, Counting)


def test_a_failed_document_is_tried_again(spark, tmp_path):
    class Down:
        def call(self, message):
            raise RuntimeError("down")

    write(tmp_path / "docs", {"a.md": BODY.format("Ann", "Acme", "Rome")})
    sources, home = [(str(tmp_path / "docs"), "r", "nested")], str(tmp_path / "home")
    first = corpus_run.ingest_folders(spark, sources, home, Down, now=at(1), attempts=1)
    assert (first["chunks_failed"], first["entities_created"]) == (1, 0)
    second = corpus_run.ingest_folders(spark, sources, home, ingest.RuleBackend, now=at(2))
    assert (second["docs_changed"], second["chunks_failed"], second["entities_created"]) == (1, 0, 3)


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["version"]) == 0 and capsys.readouterr().out.strip() == cli.VERSION
    assert cli.main(["info"]) == 0 and "mock" in capsys.readouterr().out
    assert cli.main([]) == 2 and cli.main(["ingest"]) == 2 and cli.main(["unknown"]) == 2
    assert cli.main(["ingest", "--nested-dir", str(tmp_path / "none"), "--home", str(tmp_path / "h0")]) == 2
    assert cli.main(["ingest", "--nested-dir", str(tmp_path), "--backend", "none"]) == 2
    write(tmp_path / "docs", {"a.md": "Person:Ann -WORKS_AT-> Organization:Acme"})
    assert cli.main(["ingest", "--nested-dir", str(tmp_path / "docs"), "--home", str(tmp_path / "h1")]) == 0
    assert "docs=1 (errors=0) new=1" in capsys.readouterr().out
    write(tmp_path / "docs", {"b.md": "Location:Rome -WORKS_AT-> Organization:Acme"})  # a broken signature is flagged
    assert cli.main(["ingest", "--nested-dir", str(tmp_path / "docs"), "--home", str(tmp_path / "h2")]) == 1
