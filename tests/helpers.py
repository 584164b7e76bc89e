import json


def document(contest_id, stats, home=("11", "Lake Valley", "LAKEV", "Lake Valley University"), away=("22", "Coast Tech", "COAST", "Coast Technical University"), title="Game"):
    """A document of one period; stats are (team id, clock, text or (text, home score, visitor score))."""
    teams = [{"teamId": t[0], "nameShort": t[1], "name6Char": t[2], "nameFull": t[3], "isHome": flag} for t, flag in ((home, True), (away, False)) if t]
    plays = lambda x: [{"playText": x}] if isinstance(x, str) or x is None else [{"playText": x[0], "homeScore": x[1], "visitorScore": x[2]}]
    return {"data": {"playbyplay": {"contestId": contest_id, "title": title, "status": "final", "teams": teams, "periods": [{"periodNumber": 1, "periodDisplay": "1st", "playbyplayStats": [{"teamId": t, "clock": c, "plays": plays(x)} for t, c, x in stats]}]}}}


def snapshot(folder, contest_id, texts, **names):
    """A snapshot file; texts are plain, or (container's team id, text)."""
    stats = [(x[0], "10:00", x[1]) if isinstance(x, tuple) else (None, "10:00", x) for x in texts]
    path = folder / f"{contest_id}.json"
    path.write_text(json.dumps(document(contest_id, stats, **names)))
    return contest_id, "20260101T000000Z", str(path)
