import pytest
from pyspark.sql import functions as F

from folioweave.functions.embedding import BatchEmbedder, LengthEmbedder
from folioweave.operators.chunking import ChunkSettings
from folioweave.plans import answer as A
from folioweave.plans import generation as G
from folioweave.plans.index import PaperIndex
from tests import fixtures
from tests.fixtures import PAPER


class Changed(LengthEmbedder):
    name = "changed"

    def vector(self, text):
        return F.array(F.lit(99.0), F.length(text).cast("double"), F.lit(1.0))

    def embed(self, texts):
        return [[99.0, float(len(t)), 1.0] for t in texts]


def smaller():
    return BatchEmbedder("smaller", lambda: lambda texts: [[float(len(t)), 1.0] for t in texts])


@pytest.fixture
def place(spark, tmp_path):
    where = {"run_root": str(tmp_path / "runs"), "pointer": str(tmp_path / "active.json")}

    def publish(text):
        return G.build(spark, fixtures.papers(spark), fixtures.pages(spark, text),
                       where["run_root"], where["pointer"], ChunkSettings("fixed_characters", 6, 2))

    def index(embedder=None, **changes):
        return PaperIndex(spark, str(tmp_path / "vectors"), where["run_root"], where["pointer"],
                          fixtures.search_papers(spark, {**PAPER, **changes}), embedder or LengthEmbedder())

    publish("abcdefghij")
    return publish, index


def test_index_twice_then_new_generation(spark, place):
    publish, index = place
    one = index()
    assert (one.index_papers(), one.index_chunks()) == (1, 2)
    assert (one.index_papers(), one.index_chunks()) == (0, 0)
    hit = one.search_two_stage("abc", n_papers=1, k=1).collect()
    stored = {r["id"]: r for r in one.stored("chunks").collect()}
    assert len(hit) == 1 and stored[hit[0]["chunk_id"]]["document"] == hit[0]["text"]
    assert hit[0]["pdf_url"] == PAPER["pdf_url"]
    before = set(stored)
    publish("different page content")
    with pytest.raises(RuntimeError):
        one.search("abc", 1)
    two = index()
    two.index_papers(), two.index_chunks()
    after = {r["id"] for r in two.stored("chunks").collect()}
    assert not before & after and two.count("papers") == 1
    assert {r[0] for r in two.stored("chunks").select("generation").distinct().collect()} == {two.source().name}


@pytest.mark.parametrize("embedder, size", [(Changed(), 3), (smaller(), 2)])
def test_embedder_change_needs_reindex(spark, place, embedder, size):
    _, index = place
    one = index()
    one.index_papers(), one.index_chunks()
    other = index(embedder)
    with pytest.raises(RuntimeError):
        other.search_two_stage("abc", n_papers=1, k=1)
    assert (other.index_papers(), other.index_chunks()) == (1, 2)
    assert {len(r["embedding"]) for r in other.stored("chunks").collect()} == {size}
    assert len(other.search_two_stage("abc", n_papers=1, k=1).collect()) == 1


def test_guards(spark, place):
    _, index = place
    with pytest.raises(ValueError):
        index(title="Mismatched")
    with pytest.raises(ValueError):
        index(abstract=" ")
    one = index()
    one.index_papers(), one.index_chunks()
    with pytest.raises(ValueError):
        one.search_two_stage("abc", k=0)
    assert one.search_chunks("abc", [], 1).count() == 0
    paper, passages = one.paper_embeddings(PAPER["paper_id"])
    assert paper.count() == 1 and [r["start_character"] for r in passages.collect()] == [0, 4]
    found = one.search_passages("abc", 2)
    assert [p["rank"] for p in found["passages"]] == [1, 2] and found["dimensions"] == 3


def test_answer_and_chat(spark, place):
    _, index = place
    one = index()
    one.index_papers(), one.index_chunks()
    seen = []
    text, passages = A.answer(one, "abc", lambda rules, message: seen.append(message) or "fine", k=1)
    assert text == "fine" and f"[{PAPER['paper_id']} p.1]\n{passages[0]['text']}" in seen[0]

    def always(messages, may_search):
        return {"searches": ["abc"]} if may_search else {"text": "done"}

    reply = A.chat([{"role": "user", "content": "q"}], always, lambda q: one.search_passages(q, 1))
    assert reply["content"] == "done" and len(reply["retrievals"]) == 3

    def failing(query):
        raise RuntimeError("down")

    told = []
    A.chat([{"role": "user", "content": "q"}],
           lambda m, s: told.append(m[-1]["content"]) or ({"searches": ["x"]} if len(told) == 1 else {"text": "t"}), failing)
    assert "could not be searched: down" in told[-1]
    memory = A.send_message([], "hello", lambda m: {"content": "hi", "retrievals": []})
    assert [m["role"] for m in memory] == ["user", "agent"] and "retrievals" not in memory[1]
    with pytest.raises(RuntimeError):
        A.send_message(memory, "x", failing)
    assert len(memory) == 2
    assert A.name_conversation(spark, "q", lambda p: ' "Short title." ') == "Short title"


def many(count):
    return [{**PAPER, "paper_id": f"2608.{i:05d}v1", "source_path": f"data/{i}.pdf",
             "pdf_url": f"https://arxiv.org/pdf/2608.{i:05d}v1"} for i in range(1, count + 1)]


def test_one_changed_paper_writes_one_bucket(spark, tmp_path):
    papers = many(30)
    where = (str(tmp_path / "runs"), str(tmp_path / "active.json"))

    def index(texts):
        pages = [{**p, "page_number": 1, "text": t} for p, t in zip(papers, texts)]
        G.build(spark, fixtures.papers(spark, *papers), fixtures.table(spark, pages, fixtures.schemas.PAGES),
                *where, ChunkSettings("fixed_characters", 6, 2))
        return PaperIndex(spark, str(tmp_path / "vectors"), *where, fixtures.search_papers(spark, *papers),
                          LengthEmbedder(), buckets=8)

    texts = [f"abcdefghij {i}" for i in range(30)]
    one = index(texts)
    assert (one.index_papers(), one.index_chunks()) == (30, 90)
    runs = lambda: {p.name for p in (tmp_path / "vectors" / "chunks").iterdir()}
    first = one.tables["chunks"].state()["folders"]
    assert len(set(first.values())) == 1 and 4 <= len(first) <= 8
    texts[4] = "other text"
    two = index(texts)
    assert (two.index_papers(), two.index_chunks()) == (30, 89)     # a new generation is part of every record
    second = two.tables["chunks"].state()["folders"]
    changed = {b for b in first if first[b] != second[b]}
    assert len(changed) == 1 and set(second) == set(first)
    new = (set(second.values()) - set(first.values())).pop()
    written = list((tmp_path / "vectors" / "chunks" / f"run={new}").glob("bucket=*"))
    assert [p.name for p in written] == [f"bucket={changed.pop()}"]
    assert two.tables["papers"].state()["folders"] == one.tables["papers"].state()["folders"]
    assert {r[0] for r in two.stored("chunks").select("generation").distinct().collect()} == {two.source().name}
    found = two.search_chunks("other text", [papers[4]["paper_id"]], 1)
    assert found.head()["text"] == "other "
    pruned = two.stored("chunks", [papers[4]["paper_id"]])
    assert len(pruned.inputFiles()) < len(two.stored("chunks").inputFiles())
    kept = {p.name for p in (tmp_path / "vectors" / "chunks" / f"run={first[list(first)[0]]}").glob("bucket=*")}
    for n in (7, 9):
        texts[4] = "x" * n
        index(texts).index_chunks()
    held = index(texts).tables["chunks"].state()
    named = set(held["folders"].items()) | set(held["previous"].items())
    there = {(d.name.split("=")[1], r.name.split("=")[1]) for r in (tmp_path / "vectors" / "chunks").iterdir()
             for d in r.glob("bucket=*")}
    assert there == named and len(kept) == len(first) and len(runs()) >= 3


def test_a_writer_that_lost_the_race_changes_nothing(spark, tmp_path):
    from folioweave.sources.buckets import BucketedTable
    from pyspark.sql import types as T
    schema = T._parse_datatype_string("k string, v long")
    table = BucketedTable(spark, str(tmp_path / "t"), schema, "k", 4)
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], schema)
    every = list(range(4))
    table.replace(rows, every)
    state = table.state()

    class Late(BucketedTable):
        def bucket(self, key=None):
            if not hasattr(self, "done"):
                self.done = True
                table.replace(rows.limit(0), every)
            return super().bucket(key)

    late = Late(spark, str(tmp_path / "t"), schema, "k")
    with pytest.raises(ValueError, match="moved"):
        late.replace(rows.union(rows), every)
    assert late.buckets == 4 and table.read().count() == 0 and table.state()["previous"] == state["folders"]
