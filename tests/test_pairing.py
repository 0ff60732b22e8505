"""Streamed pairing of records and documents: replayed in parts, stopped in the middle, equal to the batch join."""

import random
from datetime import datetime, timedelta

from folio.streaming.pairing import ARRIVALS, start_pairing


def test_replay_with_a_restart_equals_the_batch(spark, tmp_path):
    r = random.Random(2)
    start = datetime(2024, 1, 1)
    notes = []
    for i in range(60):
        at = start + timedelta(minutes=5 * i)
        have = r.choice(["both", "both", "xml", "pdf", "late"])
        if have in ("both", "xml", "late"):
            notes.append((f"/in/r{i}_DATA.xml", at))
        if have in ("both", "pdf"):
            notes.append((f"/in/r{i}.pdf", at + timedelta(minutes=r.randint(-20, 20))))
        if have == "late":
            notes.append((f"/in/r{i}.pdf", at + timedelta(minutes=200)))
        notes.append((f"/in/r{i}.mp4", at))
    notes.append(("/in/none.xml", None))
    notes.sort(key=lambda n: (n[1] is not None, n[1]))
    folder, out, check = (str(tmp_path / d) for d in ("in", "out", "check"))

    def deliver(rows):
        spark.createDataFrame(rows, ARRIVALS).coalesce(1).write.mode("append").parquet(folder)

    def run():
        q = start_pairing(spark, folder, out, check, "30 minutes", 1)
        q.awaitTermination(120)
        assert q.exception() is None
        return {tuple(x) for x in spark.read.parquet(out).collect()}

    half = len(notes) // 2
    deliver(notes[: half // 2])
    deliver(notes[half // 2 : half])
    first = run()
    assert any(x[3] == "pair" for x in first)
    deliver(notes[half:])
    end = start + timedelta(days=2)
    deliver([("/in/end_DATA.xml", end), ("/in/end.pdf", end)])  # moves the watermark past the rest
    deliver([("/in/end2_DATA.xml", end + timedelta(days=2)), ("/in/end2.pdf", end + timedelta(days=2))])
    deliver([("/in/end3_DATA.xml", end + timedelta(days=4)), ("/in/end3.pdf", end + timedelta(days=4))])
    got = {x for x in run() if not x[0].startswith("end")}
    assert first <= got | {x for x in first if x[0].startswith("end")}
    xml = {p[4:].removesuffix("_DATA.xml"): (p, t) for p, t in notes if p.endswith(".xml") and t}
    pdf = {p[4:].removesuffix(".pdf"): (p, t) for p, t in notes if p.endswith(".pdf")}
    want = set()
    for k in xml.keys() | pdf.keys():
        x, p = xml.get(k), pdf.get(k)
        if x and p and abs(x[1] - p[1]) <= timedelta(minutes=30):
            want.add((k, x[0], p[0], "pair"))
        else:
            want |= {(k, x[0], None, "record_without_document")} if x else set()
            want |= {(k, None, p[0], "document_without_record")} if p else set()
    assert got == want
