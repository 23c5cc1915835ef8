import hashlib
import json
import os
import pathlib
import time
import sys

import pytest
from pyspark import cloudpickle

from folioweave import schemas
from folioweave.cli import main
from folioweave.plans import generation as G
from folioweave.sources import arxiv, atom, pdf, records
from folioweave.sources.files import Files, alias_violations, file_identities
from folioweave.streaming.incremental import chunk_stream
from tests import fixtures
from tests.fixtures import PAPER, SECOND

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def feed(paper_id, entries=1, link=True):
    tail = f'<link href="http://arxiv.org/pdf/{paper_id}" type="application/pdf"/>' if link else ""
    entry = (f"<entry><id>http://arxiv.org/abs/{paper_id}</id><title> A\n  title &amp; more</title>"
             f"<published>2026-08-21T00:00:00Z</published><summary>s\n t</summary><author><name>A  B</name></author>{tail}</entry>")
    return f'<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">{entry * entries}</feed>'


def test_atom(spark):
    rows = [("2608.20316v1", feed("2608.20316v1"), "p"), ("2608.20317v1", feed("2608.20317v1", 2), "p"),
            ("2608.20318v1", feed("2608.20319v1"), "p"), ("hep-th/9901001v1", feed("hep-th/9901001v1", link=False), "p"),
            ("2608.20320v1", "not xml", "p")]
    got = {r["requested_id"]: r for r in atom.parse_entries(
        spark.createDataFrame(rows, "requested_id string, xml string, source_path string")).collect()}
    one = got["2608.20316v1"]
    assert (one["title"], one["authors"], one["published"], one["pdf_url"], one["abstract"], one["error"]) == (
        "A title & more", ["A B"], "2026-08-21", "https://arxiv.org/pdf/2608.20316v1", "s t", None)
    assert got["hep-th/9901001v1"]["pdf_url"].endswith("/pdf/hep-th/9901001v1")
    assert all(got[i]["error"] for i in ("2608.20317v1", "2608.20318v1", "2608.20320v1"))


def test_collect_is_paced_and_reports_per_paper(spark):
    now, slept = [0.0], []

    def fetch(url):
        if "20319" in url:
            raise OSError("offline")
        return feed(url.split("id_list=")[1].split("&")[0]).encode()

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    manifest = fixtures.search_papers(spark, PAPER)
    merged, report = arxiv.collect(spark, [PAPER["paper_id"], "2608.20318v1 ", "2608.20319v1"], manifest, "d",
                                   fetch, lambda: now[0], sleep)
    assert report["outcome"] == "partial_failure" and report["added_papers"] == ["2608.20318v1"]
    assert report["existing_papers"] == [PAPER["paper_id"]] and slept == [3.0] and merged.count() == 2
    for bad in (["2608.20316"], ["2608.20316v1", " 2608.20316v1"]):
        with pytest.raises(ValueError):
            arxiv.requested_ids(spark, bad)
    kept = {}
    got = arxiv.download([("a", "u1", "p1"), ("b", "u2", "p2"), ("c", "u3", "p3")], {"p2"}, kept.__setitem__,
                         lambda u: b"%PDF-1" if u == "u1" else b"<html>")
    assert got["downloaded_pdfs"] == ["a"] and got["skipped_downloads"] == ["b"] and "c" in got["failures"]


class OfflineFeed(arxiv.NewestPapers):
    @classmethod
    def name(cls):
        return "offline_papers"

    def fetch(self, url):
        return feed("2608.20316v1", 3).encode()


def test_newest_papers_source(spark):
    spark.dataSource.register(OfflineFeed)
    raw = spark.read.format("offline_papers").option("n", 3).load()
    assert atom.parse_entries(arxiv.split_entries(raw)).where("error IS NULL").count() == 3
    with pytest.raises(Exception, match="between 1 and 100"):
        spark.read.format("offline_papers").option("n", 0).load().collect()


def test_lines_manifest_and_csv(spark, tmp_path):
    page = {**PAPER, "page_number": 1, "text": "a"}
    del page["source_path"]
    good = tmp_path / "good.jsonl"
    good.write_text(json.dumps({**page, "extra": 1}) + "\n\n \n")
    assert records.read_lines(spark, str(good), schemas.PAGES).count() == 1
    for change in ('{"a":', "[1]", json.dumps({**page, "page_number": True}), json.dumps({**page, "text": 5})):
        bad = tmp_path / "bad.jsonl"
        bad.write_text(change + "\n")
        with pytest.raises(ValueError, match="bad.jsonl"):
            records.read_lines(spark, str(bad), schemas.PAGES)
    manifest = tmp_path / "papers.json"
    manifest.write_text(json.dumps([PAPER, SECOND], indent=2))
    assert records.read_manifest(spark, str(manifest), schemas.PAPERS).count() == 2
    manifest.write_text(json.dumps(PAPER))
    with pytest.raises(ValueError):
        records.read_manifest(spark, str(manifest), schemas.PAPERS)
    table = tmp_path / "m.csv"
    table.write_text("\ufefftitle,id\nx,2608.20316v1\n\"a,\nb\",2609.35770v1\n", encoding="utf-8")
    ids = records.read_metadata_ids(spark, str(table))
    assert sorted(r[0] for r in ids.collect()) == ["2608.20316v1", "2609.35770v1"] and records.id_problems(ids).count() == 0
    for header in ("id,id\n", "name\n", "id,a,a\n"):
        table.write_text(header + "1,2,3\n")
        with pytest.raises(ValueError):
            records.read_metadata_ids(spark, str(table))
    problems = records.id_problems(spark.createDataFrame([("x",), ("2608.20316v1",), ("2608.20316v1",)], "id string"))
    assert sorted(r["rule"] for r in problems.collect()) == ["duplicate", "noncanonical"]
    records.write_lines(fixtures.papers(spark), str(tmp_path / "out"))
    assert records.read_lines(spark, str(tmp_path / "out"), schemas.PAPERS).collect() == fixtures.papers(spark).collect()


def fake_reader(content):
    text = content.decode()
    if "broken" in text:
        raise ValueError("cannot parse")
    return text.split("\f") if text.strip("-") else []


def test_pdf_folder(spark, tmp_path):
    for name, text in (("fixture.pdf", "one \x00 two\f\fthree"), ("second.pdf", "ok\fbroken"), ("empty.pdf", ""), ("none.pdf", "-"), ("x.txt", "no")):
        (tmp_path / name).write_text(text)
    rows = pdf.read_pages(spark, str(tmp_path), fake_reader)
    by_name = {}
    for r in rows.collect():
        by_name.setdefault(pathlib.Path(r["path"]).name, []).append((r["page_number"], r["error"]))
    assert [n for n, _ in sorted(by_name["fixture.pdf"])] == [1, 2, 3]
    assert by_name["second.pdf"] == [(None, "cannot parse")] and by_name["none.pdf"] == [(None, None)]
    papers = fixtures.papers(spark, {**PAPER, "source_path": "fixture.pdf"}, {**SECOND, "source_path": "second.pdf"})
    pages = pdf.pages_of_papers(papers, rows, str(tmp_path)).orderBy("page_number").collect()
    assert [(p["page_number"], p["text"]) for p in pages] == [(1, "one two"), (2, ""), (3, "three")]
    assert pdf.list_files(spark, str(tmp_path)).count() == 3  # empty files are not listed


def test_files_replace_in_one_step(spark, tmp_path):
    files, target = Files(spark), str(tmp_path / "a" / "x.json")
    files.write_json(target, {"v": 1})
    files.write_json(target, {"v": "é"})
    assert files.read_json(target) == {"v": "é"} and len(files.sha256(target)) == 64
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.endswith(".crc")] == ["x.json"]
    (tmp_path / "link").symlink_to(tmp_path / "a")
    assert files.is_link(str(tmp_path / "link")) and not files.is_link(target)


def test_command_line(spark, tmp_path, capsys):
    manifest, pages = tmp_path / "papers.json", tmp_path / "pages.jsonl"
    manifest.write_text(json.dumps([PAPER]))
    page = {k: v for k, v in PAPER.items() if k != "source_path"}
    pages.write_text(json.dumps({**page, "page_number": 1, "text": "abcdefghij"}) + "\n")
    common = ["--run-root", str(tmp_path / "runs"), "--active-pointer", str(tmp_path / "active.json")]
    chunk = ["chunk", *common, "--manifest", str(manifest), "--pages", str(pages), "--profile", "fixed_characters"]

    def run(arguments, **options):
        code = main(arguments, spark, **options)
        return code, json.loads(capsys.readouterr().out)

    assert run(["inspect", *common])[0] == 3
    code, out = run(chunk)
    assert code == 0 and out["artifacts_published"]
    assert run(["inspect", *common])[1]["chunks"] == 1
    table = tmp_path / "m.csv"
    table.write_text("id\n2608.20316v1\n2609.35770v1\n")
    code, out = run(["coverage", *common, "--metadata-csv", str(table)])
    assert code == 0 and (out["shared_ids"], out["metadata_only_ids"]) == (1, 1)
    manifest.write_text(json.dumps([PAPER, SECOND]))
    assert run(chunk)[0] == 2
    code, out = run([*chunk, "--allow-partial"])
    assert code == 2 and out["artifacts_published"]
    assert run([*chunk, "--tokenizer-file", "x"])[0] == 3
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "fixture.pdf").write_text("one\ftwo")
    manifest.write_text(json.dumps([PAPER]))
    code, out = run(["run", *common, "--manifest", str(manifest), "--root", str(tmp_path)], reader=fake_reader)
    assert code == 0 and out["pages_loaded"] == 2
    assert G.load_active(spark, str(tmp_path / "runs"), str(tmp_path / "active.json")).manifest["provenance"]["input_mode"] == "pdf_pipeline"


def test_four_papers_fall_into_their_classes(spark, tmp_path, capsys):
    names = ("fixture", "second", "third", "fourth")
    rows = [{**PAPER, "paper_id": f"2608.2031{6 + i}v1", "source_path": f"data/{n}.pdf",
             "pdf_url": f"https://arxiv.org/pdf/2608.2031{6 + i}v1"} for i, n in enumerate(names)]
    manifest = tmp_path / "papers.json"
    manifest.write_text(json.dumps(rows))
    (tmp_path / "data").mkdir()
    for name, content in zip(names, ("one\ftwo", None, "broken", "empty")):
        if content:
            (tmp_path / "data" / f"{name}.pdf").write_text(content)
    calls = tmp_path / "calls"
    calls.mkdir()

    def reader(content):
        (calls / f"{len(list(calls.iterdir()))}-{content[:3].decode()}-{time.time_ns()}").write_text("")
        if content == b"broken":
            raise ValueError("broken")
        return [] if content == b"empty" else content.decode().split("\f")

    for command in (["extract", "--output", str(tmp_path / "out")],
                    ["run", "--run-root", str(tmp_path / "runs"), "--active-pointer", str(tmp_path / "a.json")]):
        code = main([*command, "--manifest", str(manifest), "--root", str(tmp_path), "--allow-partial"], spark, reader=reader)
        out = json.loads(capsys.readouterr().out)
        found = out if command[0] == "extract" else out["source_failures"]
        assert code == 2
        assert [found[n] for n in ("missing_pdfs", "parsing_failures", "papers_without_usable_text")] == [1, 1, 1]
        assert len(list(calls.iterdir())) == 3
        for call in calls.iterdir():
            call.unlink()
    kept = G.load_active(spark, str(tmp_path / "runs"), str(tmp_path / "a.json")).coverage
    assert {r["paper_id"]: r["status"] for r in kept.collect()} == {
        rows[0]["paper_id"]: "included", rows[1]["paper_id"]: "missing_pdfs", rows[2]["paper_id"]: "parsing_failures",
        rows[3]["paper_id"]: "papers_without_usable_text"}


def test_stage_commands(spark, tmp_path, capsys):
    manifest = tmp_path / "papers.json"
    manifest.write_text(json.dumps([PAPER, SECOND]))
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "fixture.pdf").write_text("one\ftwo")

    def run(*arguments, **options):
        code = main(list(arguments), spark, **options)
        return code, json.loads(capsys.readouterr().out)

    base = ["--manifest", str(manifest)]
    root = ["--root", str(tmp_path)]
    code, out = run("ingest", *base, *root, "--output", str(tmp_path / "catalog"))
    assert code == 2 and out["missing_pdfs"] == 1 and not (tmp_path / "catalog").exists()
    (tmp_path / "data" / "second.pdf").write_text("broken")
    code, out = run("ingest", *base, *root, "--output", str(tmp_path / "catalog"))
    assert code == 0 and records.read_lines(spark, str(tmp_path / "catalog"), schemas.PAPERS).count() == 2
    pages = str(tmp_path / "pages")
    code, out = run("extract", *base, *root, "--output", pages, reader=fake_reader)
    assert code == 2 and out["parsing_failures"] == 1 and not pathlib.Path(pages).exists()
    code, out = run("extract", *base, *root, "--output", pages, "--allow-partial", reader=fake_reader)
    assert code == 2 and records.read_lines(spark, pages, schemas.PAGES).count() == 2
    target = str(tmp_path / "collected")
    code, out = run("collect", "--manifest", str(tmp_path / "none.json"), "--output", target + "-bad",
                    "--arxiv-id", "2608.20317v1", "--folder", str(tmp_path / "down"),
                    fetch=lambda url: feed("2608.20317v1").encode())
    assert code == 3 and "source_path" in out["failures"]["2608.20317v1"]  # absolute folders are refused
    code, out = run("collect", "--manifest", str(tmp_path / "none.json"), "--output", target,
                    "--arxiv-id", "2608.20317v1", fetch=lambda url: feed("2608.20317v1").encode())
    assert code == 0 and out["added_papers"] == ["2608.20317v1"]
    code, out = run("chunk", *base, "--pages", str(tmp_path / "runs" / "p"), "--run-root", str(tmp_path / "runs"),
                    "--active-pointer", str(tmp_path / "a.json"))
    assert code == 3 and "alias" in out["error"]


def test_page_stream_adds_each_page_once(spark, tmp_path):
    inbox, target = tmp_path / "in", str(tmp_path / "chunks")
    inbox.mkdir()
    page = {k: v for k, v in PAPER.items() if k != "source_path"}

    def deliver(name, numbers):
        (inbox / name).write_text("".join(json.dumps({**page, "page_number": n, "text": f"page {n}"}) + "\n" for n in numbers))
        chunk_stream(spark, str(inbox), target, str(tmp_path / "state")).awaitTermination()

    deliver("a.json", [1, 2])
    deliver("b.json", [2, 3, 3])
    rows = spark.read.parquet(target)
    assert sorted(r["page_number"] for r in rows.collect()) == [1, 2, 3]


def command(spark, capsys):
    def run(*arguments, **options):
        code = main(list(arguments), spark, **options)
        return code, json.loads(capsys.readouterr().out)
    return run


@pytest.mark.parametrize("link", ["hard", "symbolic"])
def test_one_file_cannot_be_two_papers(spark, tmp_path, capsys, link):
    run, data = command(spark, capsys), tmp_path / "data"
    data.mkdir()
    (data / "fixture.pdf").write_text("one\ftwo")
    if link == "hard":
        os.link(data / "fixture.pdf", data / "second.pdf")
    else:
        (data / "second.pdf").symlink_to("fixture.pdf")
    manifest = tmp_path / "papers.json"
    manifest.write_text(json.dumps([PAPER, SECOND]))
    base = ["--manifest", str(manifest), "--root", str(tmp_path)]
    for arguments in (["ingest", *base, "--output", str(tmp_path / "catalog")],
                      ["run", *base, "--run-root", str(tmp_path / "runs"), "--active-pointer", str(tmp_path / "a.json")]):
        code, out = run(*arguments, reader=fake_reader)
        assert code == 3 and "source_path" in out["error"]
    (data / "second.pdf").unlink()
    (data / "second.pdf").write_text("one\ftwo")              # equal bytes are no alias
    assert run("ingest", *base, "--output", str(tmp_path / "catalog"))[0] == 0


def test_identities_beyond_local_disks(spark):
    rows = spark.createDataFrame([("a", "s3a://b/x.pdf"), ("b", "s3a://b/y.pdf"), ("c", None), ("d", "/no/such")],
                                 "paper_id string, path string")
    found = file_identities(rows)
    assert {r["paper_id"]: r["file_key"] for r in found.collect()} == dict.fromkeys("abcd")
    assert alias_violations(found).count() == 0
    assert alias_violations(found.unionAll(found.where("paper_id = 'a'"))).head()["rule"] == "source_path_shared"


def test_targets_cannot_be_inputs_by_any_spelling(spark, tmp_path, capsys):
    run = command(spark, capsys)
    manifest, pages, pointer = tmp_path / "papers.json", tmp_path / "pages.jsonl", tmp_path / "active.json"
    manifest.write_text(json.dumps([PAPER]))
    page = {k: v for k, v in PAPER.items() if k != "source_path"}
    pages.write_text(json.dumps({**page, "page_number": 1, "text": "abc"}) + "\n")
    (tmp_path / "runs").mkdir()
    (tmp_path / "aside").symlink_to("runs")
    (tmp_path / "runs" / "in.json").write_text(json.dumps([PAPER]))
    common = ["chunk", "--pages", str(pages), "--run-root", str(tmp_path / "runs")]
    code, out = run(*common, "--manifest", str(tmp_path / "aside" / "in.json"), "--active-pointer", str(pointer))
    assert code == 3 and "alias" in out["error"]
    code, out = run(*common, "--manifest", str(manifest), "--active-pointer", str(tmp_path / "aside" / "a.json"))
    assert code == 3 and "outside" in out["error"]
    os.link(manifest, pointer)
    code, out = run(*common, "--manifest", str(manifest), "--active-pointer", str(pointer))
    assert code == 3 and "alias" in out["error"] and json.loads(manifest.read_text()) == [PAPER]


def test_a_source_that_changes_midway_publishes_nothing(spark, tmp_path, capsys, monkeypatch):
    run, pointer = command(spark, capsys), tmp_path / "active.json"
    manifest, pages, catalog = tmp_path / "papers.json", tmp_path / "pages.jsonl", tmp_path / "catalog.jsonl"
    tokens, data = tmp_path / "tokens.json", tmp_path / "data"
    data.mkdir()
    page = {k: v for k, v in PAPER.items() if k != "source_path"}
    tokenizers = pytest.importorskip("tokenizers")
    built = tokenizers.Tokenizer(tokenizers.models.WordLevel({"[UNK]": 0}, unk_token="[UNK]"))
    built.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    contents = {manifest: json.dumps([PAPER]), catalog: json.dumps(PAPER) + "\n", tokens: built.to_str(),
                pages: json.dumps({**page, "page_number": 1, "text": "abc def"}) + "\n", data / "fixture.pdf": "one\ftwo"}
    base = ["--manifest", str(manifest), "--run-root", str(tmp_path / "runs"), "--active-pointer", str(pointer)]
    chunk = ["chunk", *base, "--pages", str(pages), "--catalog", str(catalog), "--profile", "tokenizer",
             "--tokenizer-file", str(tokens), "--tokenizer-model-id", "m", "--tokenizer-revision", "1"]
    pdfs = ["run", *base, "--root", str(tmp_path)]
    staged = G.facts.quality_facts
    for arguments, changed in ((chunk, manifest), (chunk, pages), (chunk, catalog), (chunk, tokens),
                               (pdfs, data / "fixture.pdf"), (pdfs, manifest)):
        for path, content in contents.items():
            path.write_text(content)

        def touch(*given, **named):
            changed.write_text(contents[changed] + " ")
            return staged(*given, **named)

        monkeypatch.setattr(G.facts, "quality_facts", touch)
        code, out = run(*arguments, reader=fake_reader)
        assert code == 3 and not out["artifacts_published"] and "changed" in out["error"], changed
        assert not pointer.exists()
    monkeypatch.setattr(G.facts, "quality_facts", staged)
    for path, content in contents.items():
        path.write_text(content)
    assert run(*pdfs, reader=fake_reader)[0] == 0
    found = G.load_active(spark, str(tmp_path / "runs"), str(pointer))
    entry = found.sources.head()
    assert entry["sha256"] == hashlib.sha256(b"one\ftwo").hexdigest() and entry["status"] == "read"
    assert entry["reader"].endswith("fake_reader") and entry["reader_version"].startswith("code ")
    assert found.manifest["provenance"]["dependencies"]["reader_version"] == entry["reader_version"]
