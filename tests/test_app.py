"""The whole shop through the command line, with folders as topics."""

import json

import pytest

from retailtide.app import main

START = 1566086400000  # 2019-08-18 00:00 UTC


def put(folder, *records):
    folder.mkdir(parents=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records)
    (folder / "0.txt").write_text(text + "\n")


def image(**columns):
    return [{"name": k, "value": v} for k, v in columns.items()]


def change(table, op, *rows):
    return {"entry_type": "ROWDATA", "table": table, "op": op, "rows": list(rows)}


def test_shop(spark, tmp_path):
    topics, tables = tmp_path / "topics", str(tmp_path / "tables")

    def run(job, folder, out=None):
        args = ["run", job, "--folder", str(folder), "--tables", tables, "--once"]
        args += ["--checkpoints", str(tmp_path / "checkpoints")]
        main(args + (["--out", str(out)] if out else []), spark)

    def answer(*args):
        return [json.loads(t) for t in main(["answer", *args, "--tables", tables], spark)]

    # logs: stamped, archived, routed
    raw = tmp_path / "raw"
    put(raw / "raw_log", {"type": "startup", "mid": "m", "ts": 1}, {"mid": "n"}, "broken")
    run("archive", raw, tmp_path / "archive")
    run("logs", raw, tmp_path / "routed")
    archived = [p for p in (tmp_path / "archive").rglob("*.txt")]
    assert sum(len(p.read_text().splitlines()) for p in archived) == 2
    assert {p.parent.name for p in (tmp_path / "routed").rglob("*.txt")} == {
        "topic=startup",
        "topic=event",
        "topic=broken",
    }

    # change records: routed to topics
    put(
        raw / "raw_change",
        change(
            "order_info",
            "INSERT",
            image(id="1", user_id="u", create_time="2019-08-18 09:05:00", total_amount="12.5",
                  consignee_tel="13012345678", order_status="1"),
        ),
        change("order_info", "UPDATE", image(id="1", order_status="2")),
        change("order_detail", "INSERT",
               image(id="a", order_id="1", sku_name="Red Gear", order_price="2.5"),
               image(id="b", order_id="1", sku_name="Blue Gear", order_price="10.0")),
        change("user_info", "INSERT", image(id="u", gender="M", birthday="1990-01-01")),
        '{"table":"order_info"}',
        '["x"]',
    )
    run("changes", raw, tmp_path / "feeds")
    topics.mkdir()
    for topic in ("order", "order_detail", "user_info"):
        (topics / topic).symlink_to(tmp_path / "feeds" / f"topic={topic}")
    put(
        topics / "startup",
        {"mid": "m", "type": "startup", "ts": START + 3_600_000},
        {"mid": "m", "type": "startup", "ts": START + 60_000},
        {"mid": "n", "type": "startup", "ts": str(START - 1)},
    )
    put(
        topics / "event",
        *[{"mid": "m", "uid": u, "evid": "coupon", "itemid": "i", "ts": START} for u in "abc"],
        {"mid": "z", "uid": "a", "evid": "addCart", "ts": START + 3_600_000},
    )
    for job in ("users", "visits", "orders", "sales", "alerts"):
        run(job, topics)

    # every text that some job could not use is in the quarantine
    put(topics / "broken", *[line for p in (tmp_path).rglob("topic=broken/*.txt") for line in p.read_text().splitlines()])
    run("quarantine", topics, tmp_path / "bad")
    bad = sorted((p.parent.parent.name, p.parent.name, json.loads(line)["value"]) for p in (tmp_path / "bad").rglob("*.json") for line in p.read_text().splitlines())
    assert bad == [
        ("topic=raw_change", "reason=broken", '["x"]'),
        ("topic=raw_change", "reason=no type", '{"table":"order_info"}'),
        ("topic=raw_log", "reason=broken", "broken"),
    ]

    totals = {t["id"]: t["value"] for t in answer("total", "--date", "2019-08-18")}
    assert totals == {"dau": 1.0, "new_mid": 1.0, "order_amount": 12.5}
    (hours,) = answer("hours", "--date", "2019-08-18")
    assert hours["today"]["00"] == 1 and hours["yesterday"]["23"] == 1
    assert list(hours["today"]) == [f"{h:02}" for h in range(24)]
    (amounts,) = answer("hours", "--date", "2019-08-18", "--metric", "order_amount")
    assert sum(amounts["today"].values()) == 12.5
    assert answer("hours", "--date", "2019-08-18", "--metric", "other") == []

    (found,) = answer("sales", "--date", "2019-08-18", "--keyword", "gear", "--size", "1")
    assert found["total"] == 2
    assert [d["order_detail_id"] for d in found["detail"]] == ["a"]
    assert found["detail"][0]["user_gender"] == "M"
    assert found["stat"][0]["options"][0]["value"] == 100.0

    from retailtide.streaming import alert_table

    alerts = alert_table(f"{tables}/alerts").read(spark)
    assert {r["mid"] for r in alerts.collect()} == {"m"}


def test_a_job_needs_a_source(spark):
    with pytest.raises(SystemExit):
        main(["run", "visits"], spark)
