"""Rows and frames that several test modules share. (Not in conftest: every folder of tests has one of its own.)"""

from __future__ import annotations

import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def alarm(alarm_id, site_id="SITE-00001", severity="Major", raised="2024-01-01 10:00:00", cleared=None, **kw):
    row = {
        "alarm_id": alarm_id,
        "site_id": site_id,
        "node_id": kw.get("node_id", "ENB-00001"),
        "alarm_type": kw.get("alarm_type", "LinkDown"),
        "severity": severity,
        "raised_ts": ts(raised),
        "cleared_ts": ts(cleared) if cleared else None,
        "status": kw.get("status", "CLEARED" if cleared else "ACTIVE"),
        "probable_cause": kw.get("probable_cause", "FiberCut"),
        "event_date": raised[:10],
    }
    return row


def site(site_id, region="R1", vendor="V1", lat=30.0, lon=-90.0):
    return {
        "site_id": site_id,
        "site_name": f"N-{site_id}",
        "region": region,
        "state": "S",
        "vendor": vendor,
        "equipment_type": "EQ1",
        "latitude": lat,
        "longitude": lon,
        "install_date": ts("2020-01-01 00:00:00"),
    }


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
