"""Outbox, receipts and answers on record, with runs that die in between."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedmill.ledger import Ledger, Pace
from feedmill.outbox import Outbox
from feedmill.provider import Durable, Http


def rows(spark, n, start=0):
    return spark.range(start, n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}")).alias("body"))


def recorder(folder, dies_at=None, refuses=()):
    """Sends into files, one for each request; dies at a key."""
    folder.mkdir(exist_ok=True)

    def send(body, identifier):
        numbers = [x["n"] for x in json.loads(body)]
        if dies_at in numbers:
            raise RuntimeError("the executor is gone")
        if any(n in refuses for n in numbers):
            return 500
        (folder / identifier).write_bytes(body)
        return 200

    return send


def sent(folder):
    return Counter(x["n"] for f in folder.iterdir() for x in json.loads(f.read_bytes()))


def test_delivery_once_by_key_over_a_crash(spark, tmp_path):
    box, got = Outbox(str(tmp_path / "box"), 4), tmp_path / "got"
    assert box.deliver(spark, recorder(got)) == {"asked": 0, "answered": 0}
    box.add(rows(spark, 60).repartition(5), "run1")
    with pytest.raises(Exception, match="gone"):
        box.deliver(spark, recorder(got, dies_at=37), per_request=3)
    before = sent(got)
    assert len(before) < 60
    box.add(rows(spark, 80, 40), "run2")  # keys of the first run come again
    box.deliver(spark, recorder(got), per_request=3)
    assert sent(got) == Counter(range(80))
    assert box.deliver(spark, recorder(got)) == {"asked": 0, "answered": 0}
    assert box.pending(spark).count() == 0


def test_what_is_refused_stays_pending(spark, tmp_path):
    box, got = Outbox(str(tmp_path / "box"), 2), tmp_path / "got"
    box.add(rows(spark, 10))
    assert box.deliver(spark, recorder(got, refuses={4}), per_request=1) == {"asked": 10, "answered": 9}
    assert [r["key"] for r in box.pending(spark).collect()] == ["k4"]
    tries = []

    def flaky(body, identifier):
        (tmp_path / f"try-{len(list(tmp_path.glob('try-*')))}").touch()
        if len(list(tmp_path.glob("try-*"))) < 3:
            raise OSError("not now")
        return 204

    assert box.deliver(spark, flaky, delays=(0, 0, 0)) == {"asked": 1, "answered": 1} and not tries


def test_a_run_that_fails_commits_nothing(spark, tmp_path):
    box = Outbox(str(tmp_path / "box"))
    bad = rows(spark, 20).repartition(4).withColumn("body", F.when(F.col("key") == "k7", F.raise_error(F.lit("broken row"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="broken row"):
        box.add(bad, "run1")
    assert box.committed(spark).count() == 0
    box.add(rows(spark, 0), "empty")
    assert box.committed(spark).count() == 0
    box.add(rows(spark, 3), "run2")
    (tmp_path / "box" / "parts" / "stray.parquet").write_bytes(next((tmp_path / "box" / "parts").glob("run2*")).read_bytes())
    assert sorted(r["key"] for r in box.committed(spark).collect()) == ["k0", "k1", "k2"]


def endpoint(folder, fails=(), dies_at=None):
    folder.mkdir(exist_ok=True)

    def send(url, key, payload):
        said = payload["messages"][-1]["content"]
        (folder / f"{said}-{len(list(folder.glob(said + '-*')))}").touch()
        if said == dies_at:
            raise RuntimeError("the executor is gone")
        if said in fails:
            raise OSError("busy")
        return json.dumps({"choices": [{"message": {"content": said.upper()}}]})

    return send


def test_answers_are_asked_once(spark, tmp_path):
    calls = tmp_path / "calls"
    provider = lambda **k: Durable(Http("openai", "u", "k", "m", send=endpoint(calls, **k), delays=(0, 0)), Ledger(str(tmp_path / "answers"), 3))
    prompts = spark.createDataFrame([(f"i{i}", f"p{i % 12}", None) for i in range(30)] + [("none", None, None)], "source_key string, prompt string, system string")
    with pytest.raises(Exception, match="gone"):
        provider(dies_at="p5", fails={"p3"}).answer(prompts)
    tried = len(list(calls.glob("p3-*")))
    got = {r["source_key"]: r["answer"] for r in provider(fails={"p3"}).answer(prompts).collect()}
    assert got["i4"] == "P4" and got["i16"] == "P4" and got["i3"] is None
    counts = Counter(f.name.split("-")[0] for f in calls.iterdir())
    assert counts["p3"] == tried + 2  # tried twice, no entry
    assert all(counts[f"p{i}"] == 1 for i in range(12) if i not in (3, 5)) and counts["p5"] == 2
    again = {r["source_key"]: r["answer"] for r in provider().answer(prompts).collect()}
    assert again["i3"] == "P3" and Counter(f.name.split("-")[0] for f in calls.iterdir()) == counts + Counter(["p3"])
    # Another model is another question.
    other = Durable(Http("openai", "u", "k", "m2", send=endpoint(calls), delays=(0,)), Ledger(str(tmp_path / "answers"), 3))
    assert other.answer(prompts.limit(1)).first()["answer"] == "P0" and len(list(calls.glob("p0-*"))) == 2


def test_entries_after_compaction(spark, tmp_path):
    ledger = Ledger(str(tmp_path / "l"), 3)
    ledger.compact(spark)
    ledger.work(rows(spark, 30), lambda batch: [k.upper() for k, _ in batch], batch=2)
    before = sorted(ledger.read(spark).collect())
    ledger.compact(spark)
    assert sorted(ledger.read(spark).collect()) == before and len(before) == 30
    assert len(list((tmp_path / "l").glob("bucket=*/*.parquet"))) <= 3
    assert ledger.work(rows(spark, 31), lambda batch: [k for k, _ in batch]) == {"asked": 1, "answered": 1}


def test_pace():
    now, slept = [0.0], []
    pace = Pace(2, sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)), clock=lambda: now[0])
    for _ in range(3):
        pace.wait()
    assert slept == [0.5, 0.5]
    Pace(None, sleep=slept.append).wait()
    assert len(slept) == 2


def test_run_leaves_its_items_for_delivery(spark, tmp_path, capsys):
    from feedmill import cli
    from test_pipeline import AS_OF, CFG, HUB, LONG, article, link

    (tmp_path / "c.json").write_text(json.dumps(CFG))
    spark.createDataFrame([(HUB, f"<ul>{link(1, '25.01.2026')}</ul>")], "url string, html string").write.parquet(str(tmp_path / "in" / "listing_pages"))
    fetched = [("https://site.de/news/a1", 200, article(LONG * 8), None, None, "auto")]
    spark.createDataFrame(fetched, "url string, http_status int, static_html string, rendered_html string, crawled_html string, fetch_method string").write.parquet(str(tmp_path / "in" / "fetched"))
    args = ["--config", str(tmp_path / "c.json"), "--input", str(tmp_path / "in"), "--state", str(tmp_path / "state"), "--results", str(tmp_path / "out"), "--as-of", AS_OF.isoformat(), "--outbox", str(tmp_path / "box")]
    assert cli.main(args, spark) == 0
    got = tmp_path / "got"
    got.mkdir()
    send = lambda url, body, identifier: (got / identifier).write_bytes(body) and 200
    assert cli.deliver(["--outbox", str(tmp_path / "box"), "--url", "https://hook"], spark, send) == 0
    (item,) = json.loads(next(got.iterdir()).read_bytes())
    assert item["url"] == "https://site.de/news/a1" and item["category"] == "law" and item["keywords"] == ["Betrug"] and item["date"].startswith("2026-01-25")
    assert "delivered 1 of 1" in capsys.readouterr().out
    assert cli.deliver(["--outbox", str(tmp_path / "box"), "--url", "https://hook"], spark, send) == 0
    assert cli.main(["deliver"], spark) == 2
