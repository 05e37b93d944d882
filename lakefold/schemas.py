"""Bronze contracts: one explicit ``StructType`` per feed.

All Bronze values are text.  ``required`` lists the fields the producer
contract marks non-null (checked by ``operators.ingest.split_contract``);
the others are nullable.  Readers pass these schemas so that no scan infers
types.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[str, ...]
    required: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f, T.StringType(), f not in self.required) for f in self.fields]
        )


# Field lists and required fields of the feed contracts.
NEWS = Contract(
    "news_collection",
    ("publish_date", "publisher", "title", "url", "description", "keyword"),
    ("publish_date", "title", "url", "keyword"),
)
AIR = Contract(
    "air_quality",
    (
        "cityName", "cityNameEng", "coValue", "dataGubun", "dataTime", "districtCode",
        "districtNumSeq", "itemCode", "khaiValue", "no2Value", "numOfRows", "o3Value", "pageNo",
        "pm10Value", "pm25Value", "resultCode", "resultMsg", "returnType", "searchCondition",
        "serviceKey", "sidoName", "so2Value", "totalCount",
    ),
    ("dataTime", "sidoName"),
)
CENSUS = Contract(
    "census_data_collection",
    (
        "TBL_NM", "PRD_DE", "TBL_ID", "ITM_NM", "ITM_NM_ENG", "ITM_ID", "UNIT_NM", "ORG_ID",
        "UNIT_NM_ENG", "C1_OBJ_NM", "C1_OBJ_NM_ENG", "DT", "PRD_SE", "C1", "C1_NM", "C1_NM_ENG",
    ),
    ("PRD_DE", "TBL_ID", "ITM_ID", "ORG_ID", "DT", "C1"),
)
TEST = Contract("test", ("name", "email"), ("name", "email"))

CONTRACTS = {c.name: c for c in (NEWS, AIR, CENSUS, TEST)}
