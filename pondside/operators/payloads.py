"""The typed fields of the complements, as rows."""

from pyspark.sql import DataFrame

from pondside.functions.payload import with_payload
from pondside.schemas import OBSERVATION_PAYLOAD, SITE_PAYLOAD, VISIT_IDS_PAYLOAD
from pondside.sources.tables import Survey

PAYLOADS = {
    "site": ("site_complements", SITE_PAYLOAD),
    "visit": ("visit_complements", VISIT_IDS_PAYLOAD),
    "observation": ("observation_complements", OBSERVATION_PAYLOAD),
}


def json_fields(db: Survey, entity: str) -> DataFrame:
    """Typed payload fields of each complement of an entity."""
    relation, payload = PAYLOADS[entity]
    return with_payload(db[relation], payload)
