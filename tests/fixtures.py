"""Fixture builders: the sample export and the worked anomaly case, generated from FIXTURES.md tables."""

import datetime as dt
import json
import os

HEADER = ["Detalhes", "Nome", "Data e hora", "Valor (l)", "Leitura (l)"]


def meter_rows(device, alias, day, count, step_minutes, litres, start_reading=1_200_000):
    rows = []
    t0 = dt.datetime.combine(day, dt.time(0, 0))
    for i in range(count):
        t = t0 + dt.timedelta(minutes=step_minutes * i)
        reading = start_reading + i * int(litres)
        rows.append([device, alias, t.strftime("%d/%m/%Y %H:%M"), str(litres), f"{reading:,}".replace(",", " ")])
    return rows


def sample_document(day=dt.date(2025, 10, 22)):
    body = (meter_rows("C16SE010255", "75888", day, 80, 15, 130)
            + meter_rows("C16SC003896", "129349", day, 76, 15, 115)
            + meter_rows("97WWK12134", "101500", day, 24, 60, 8))
    return {"header": HEADER, "footer": None, "body": body}


def worked_batch_document():
    doc = sample_document()
    doc["body"] += meter_rows("NEWMETER01", "", dt.date(2025, 10, 22), 5, 60, 10)
    return doc


def worked_history_documents():
    docs = []
    for day in (dt.date(2025, 10, 20), dt.date(2025, 10, 21)):
        body = (meter_rows("C16SE010255", "75888", day, 40, 15, 130)
                + meter_rows("C16SC003896", "129349", day, 96, 15, 115)
                + meter_rows("97WWK12134", "101500", day, 24, 60, 8)
                + meter_rows("SILENT01", "", day, 24, 60, 1))
        docs.append({"header": HEADER, "footer": None, "body": body})
    return docs


def write_json(folder, name, payload):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(payload, fh)
    return path
