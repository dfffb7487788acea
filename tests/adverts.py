"""Hand-written adverts for the unit tests."""

import json

from advertlake.schema import RAW_AD

INGESTED_AT = "2026-09-03 12:00:00"
START_DATE = "2026-01-01"


def advert(**changes):
    ad = {
        "id": "A-100",
        "adref": "x7",
        "title": "Backend Programmer",
        "description": "Keeps the harbour's ledgers running.",
        "company": {"display_name": "Colmar Docks"},
        "salary_min": 41000,
        "salary_max": 52000,
        "salary_is_predicted": 1,
        "created": "2026-05-04T07:15:00Z",
        "category": {"tag": "it-jobs", "label": "Computing"},
        "location": {"area": ["FR", "Grand Est", "Colmar"], "display_name": "Colmar"},
        "latitude": 48.08,
        "longitude": 7.36,
        "contract_type": "part_time",
        "contract_time": "contract",
        "redirect_url": "https://example.net/a/100",
    }
    ad.update(changes)
    return ad


def page(number, ads, count=None):
    return json.dumps({"count": len(ads) if count is None else count, "page": number, "results": ads}, ensure_ascii=False)


def raw_frame(spark, ads, country="gb"):
    """Adverts as the reader would deliver them: one page, in reading order."""
    from advertlake.sources.pages import explode_ads, parse_pages

    payloads = spark.createDataFrame([(page(1, ads), "2026-09-03", country)], "value string, ingest_date string, country string")
    return explode_ads(parse_pages(payloads)).select(*RAW_AD.names, "country", "page", "pos")
