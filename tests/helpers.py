"""Small match documents and row helpers of the tests."""

from __future__ import annotations

import json


def ball(batter="A1", bowler="B1", runs=0, extras=None, wickets=None, other="A2"):
    """One delivery; ``extras`` adds to the total."""
    more = sum(value for value in (extras or {}).values() if value)
    value = {"batter": batter, "bowler": bowler, "non_striker": other, "runs": {"batter": runs, "extras": more, "total": runs + more}}
    if extras is not None:
        value["extras"] = extras
    if wickets is not None:
        value["wickets"] = wickets
    return value


def innings(team, *overs):
    return {"team": team, "overs": [{"over": number, "deliveries": list(balls)} for number, balls in enumerate(overs)]}


def match(*parts, event="Indian Premier League", season="2024", revision=1, date="2024-04-01", teams=("A", "B"), **info):
    body = {
        "dates": [date], "season": season, "gender": "male", "match_type": "T20", "teams": list(teams), "venue": "Ground",
        "city": "Town", "toss": {"winner": teams[0], "decision": "bat"}, "outcome": {"winner": teams[0], "by": {"runs": 3}},
        "registry": {"people": {"A1": "id-a1", "B1": "id-b1"}}, "player_of_match": ["A1"], **info,
    }
    if event is not None:
        body["event"] = {"name": event, "match_number": 1}
    return {"meta": {"data_version": "1.1.0", "created": date, "revision": revision}, "info": body, "innings": list(parts)}


def documents(spark, *files):
    """``(file name, document or text)`` pairs as a scanned document table."""
    rows = [(f"file:/in/{name}", body if isinstance(body, str) else json.dumps(body)) for name, body in files]
    return spark.createDataFrame(rows, "source_path string, raw_json string")


def parsed(spark, *files, run="r1"):
    from scorebook.operators import documents as docs

    return docs.shape_raw(docs.parse_documents(documents(spark, *files)), run)


def dicts(df, *order):
    return [row.asDict(recursive=True) for row in (df.orderBy(*order) if order else df).collect()]
