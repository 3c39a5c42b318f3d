"""Fixed values of the standard jobs, stated as tables.

They have to equal the values found in the data. Names of customers, people and installations are not among them: those
come in as parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from tallyloom.functions.cases import pattern
from tallyloom.functions.columns import segment, strip_zeros
from tallyloom.operators.shape import MISSING

# Keys of the event attributes the standard jobs use.
EVENT_KEYS = (
    "source", "sourceModule", "Retail_Bizstep", "transactionId", "referenceListSerial",
    "Retail_Premise", "Retail_SOHStoreNumber", "Retail_StoreNumber", "doorEvent", "zone",
)
RULE_KEYS = ("thingType", "specName", "bridgeKey_2", "source", "sourceModule", "Retail_Bizstep")
RULE_TARGETS = ("FeatureSet", "Process", "SubProcess", "Is_InternalEvent")
LIST_KEY_PARTS = ("tenantCode", "thingType", "bridgeKey_2", "specName", "source")

# Resource name pattern -> component, in order.
COMPONENT_BY_NAME = (
    ("%mongo-shard%", "Mongo DB Platform - Shard"),
    ("%mongo-vm%", "Mongo DB Platform - Shard"),
    ("%mongo-router%", "Mongo DB Platform - Router"),
    ("%mongo-config%", "Mongo DB Platform - config"),
    ("%mongo-analytics%", "Mongo DB Analytics"),
    ("%mongo-temp%", "Mongo DB Platform - Temp"),
    ("%kafka%", "Kafka Browser"),
    ("%gke%", "Containers (gke)"),
    ("%report%", "Reports"),
    ("%nfs%", "NFS"),
    ("%rabbit%", "Rabbit"),
    ("%sftp%", "SFTP"),
    ("%vpn%", "VPN"),
    ("%manager%", "Manager"),
    ("%postgres%", "Postgres"),
    ("%powerbi%", "Power BI"),
    ("monitoring%", "Monitoring"),
    ("analytics%", "Microservices Analytics"),
    ("%vpc--connector%", "VPC Connector"),
)
# Global name pattern -> component, in order.
COMPONENT_BY_GLOBAL_NAME = (
    ("%forwarding_rule%", "Forwarding Rule"),
    ("%cloudfunctions%", "Cloud Functions"),
    ("%cloudsql%", "Cloud SQL"),
    ("%bigquery%", "BigQuery"),
    ("%run.googleapis%", "Run Google APIs"),
    ("%compute.googleapis%", "Compute Google APIs"),
    ("%firestore.googleapis%", "Firestore"),
    ("%dataflow.googleapis.com%", "Dataflow"),
    ("%storage.googleapis.com%", "Cloud Storage"),
)
# Resource name pattern -> sub-component, in order.
SUBCOMPONENT_BY_NAME = (
    ("%mongo-shard-1%", "Mongo DB Platform - Shard 1"),
    ("%mongo-shard-2%", "Mongo DB Platform - Shard 2"),
    ("%mongo-shard-3%", "Mongo DB Platform - Shard 3"),
    ("%mongo-shard-4%", "Mongo DB Platform - Shard 4"),
    ("%mongo-shard-5%", "Mongo DB Platform - Shard 5"),
    ("%mongo-shard-6%", "Mongo DB Platform - Shard 6"),
    ("%mongo-shard-7%", "Mongo DB Platform - Shard 7"),
    ("%mongo-shard-01%", "Mongo DB Platform - Shard 1"),
    ("%mongo-shard-02%", "Mongo DB Platform - Shard 2"),
    ("%mongo-shard-03%", "Mongo DB Platform - Shard 3"),
    ("%mongo-shard-04%", "Mongo DB Platform - Shard 4"),
    ("%mongo-shard-05%", "Mongo DB Platform - Shard 5"),
    ("%mongo-shard-06%", "Mongo DB Platform - Shard 6"),
    ("%mongo-shard-07%", "Mongo DB Platform - Shard 7"),
    ("%mongo-analytics-01%", "Mongo DB Analytics - Shard 1"),
    ("%mongo-analytics-02%", "Mongo DB Analytics - Shard 2"),
    ("%mongo-vm002%", "Mongo DB Platform - Shard 0"),
    ("%mongo-vm001%", "Mongo DB Platform - Shard 0"),
    ("%mongo-vm003%", "Mongo DB Platform - Shard 0"),
)
# Substring of the resource name -> component or sub-component for the last-match reading used with stored sizes.
COMPONENT_CONTAINS = (
    ("mongo-shard", "Mongo DB Platform - Shard"),
    ("mongo-vm", "Mongo DB Platform - Shard"),
    ("mongo-router", "Mongo DB Platform - Router"),
    ("mongo-config", "Mongo DB Platform - config"),
    ("mongo-analytics", "Mongo DB Analytics"),
    ("mongo-temp", "Mongo DB Platform - Temp"),
    ("kafka", "Kafka Browser"),
    ("gke", "Containers (gke)"),
    ("report", "Reports"),
    ("nfs", "NFS"),
    ("rabbit", "Rabbit"),
    ("sftp", "SFTP"),
    ("vpn", "VPN"),
    ("manager", "Manager"),
    ("postgres", "Postgres"),
    ("powerbi", "Power BI"),
)
SUBCOMPONENT_CONTAINS = (
    ("mongo-shard-1", "Mongo DB Platform - Shard 1"),
    ("mongo-shard-2", "Mongo DB Platform - Shard 2"),
    ("mongo-shard-3", "Mongo DB Platform - Shard 3"),
    ("mongo-shard-4", "Mongo DB Platform - Shard 4"),
    ("mongo-shard-5", "Mongo DB Platform - Shard 5"),
    ("mongo-shard-6", "Mongo DB Platform - Shard 6"),
    ("mongo-shard-7", "Mongo DB Platform - Shard 7"),
    ("mongo-vm002", "Mongo DB Platform - Shard 0"),
    ("mongo-vm001", "Mongo DB Platform - Shard 0"),
    ("mongo-vm003", "Mongo DB Platform - Shard 0"),
    ("mongo-router", "Mongo DB Platform - Router"),
    ("mongo-config", "Mongo DB Platform - Config"),
    ("mongo-analytics", "Mongo DB Platform - Analytics"),
    ("mongo-temp", "Mongo DB Platform - Temp"),
)
# Substring of the shard id -> sub-component, the last one contained decides.
SHARD_CONTAINS = (
    ("rs0", "Mongo DB Platform - Shard 0"),
    ("rs0_1", "Mongo DB Platform - Shard 1"),
    ("rs0_2", "Mongo DB Platform - Shard 2"),
    ("rs0_3", "Mongo DB Platform - Shard 3"),
    ("rs0_4", "Mongo DB Platform - Shard 4"),
    ("rs0_5", "Mongo DB Platform - Shard 5"),
    ("rs0_6", "Mongo DB Platform - Shard 6"),
    ("rs0_7", "Mongo DB Platform - Shard 7"),
    ("config", "Mongo DB Platform - Config"),
)
# Component names that contain one of these are shared by everybody.
WHOLE_COMPONENTS = ("Analytics", "Router", "Temp")

# Tax and credit adjustment of the monthly report: a yearly credit spread over the hours, and a percentage.
MONTHLY_FLAT_CREDIT = 3750.0
MONTHLY_RATE = 0.05

# Measures of the billing units.
UNIT_SUMS = {"bytes_h": "bytes", "requests_h": "requests", "seconds_h": "seconds", "bytes_seconds_h": "byte-seconds"}

NO_STORE = "No Store"


def event_routes(
    listed_sources: Sequence[str], item_sources: Sequence[str], app_specs: Sequence[str], reader_specs: Sequence[str],
    product_specs: Sequence[str], item_store_sources: Sequence[str] | None = None, scheduled_sources: Sequence[str] = (),
) -> list[tuple[dict, object, object]]:
    """(condition, event source, store code): the first condition that holds decides both.

    Parameters are what differs between installations: the source codes of listed partners, the specs of the mobile
    app, of fixed readers and of product feeds. Items of a partner in ``item_sources`` have an event source, those of one in
    ``item_store_sources`` (the same ones if not given) a store code. ``scheduled_sources`` run their reports by schedule.
    """
    stores = list(item_sources if item_store_sources is None else item_store_sources)
    source, bridge, store_number = F.col("source"), F.col("bridgeKey_2"), F.col("Retail_StoreNumber")
    premise, fixture = strip_zeros("Retail_Premise"), strip_zeros("premise_from_fixture")
    stock, content = strip_zeros("Retail_SOHStoreNumber"), strip_zeros("premise_from_biz")
    door, area = segment("doorEvent", "/", 2), segment("zone", "_", 0)
    reader, reader_store = segment("bridgeKey_2", "_", 0), segment("bridgeKey_2", "_", 1)
    app = {"specName": list(app_specs), "bridgeKey_2": ["MOBILE", "FLOW", "SERVICES"], "source": ["MOBILE", "FLOW"]}
    epcis = {"specName": "EPCIS", "bridgeKey_2": "EPCIS"}
    # Fixed values.
    return [
        ({"thingType": "EPCISEVENT", **epcis, "source": list(listed_sources)}, source, premise),
        ({"thingType": "ITEM", **app}, source, fixture),
        ({"thingType": "ITEM", **epcis, "source": [s for s in item_sources if s in stores]}, source, premise),
        ({"thingType": "ITEM", **epcis, "source": [s for s in item_sources if s not in stores]}, source, MISSING),
        ({"thingType": "ITEM", **epcis, "source": [s for s in stores if s not in item_sources]}, MISSING, premise),
        ({"thingType": "ITEM", "specName": "POE_IINTERFACE", "source": "FLOW_ALE", "sourceModule": "N/A", "Retail_Bizstep": "N/A"}, source, door),
        ({"thingType": "ITEM", "specName": "POS_IINTERFACE", "source": "FLOW", "sourceModule": "N/A", "Retail_Bizstep": "N/A"}, source, area),
        ({"thingType": "ITEM", "specName": list(reader_specs), "bridgeKey_2": pattern("ALEB%"), "source": "N/A"}, reader, reader_store),
        ({"thingType": "ITEM", "specName": "SCHEDULED", "bridgeKey_2": "RULESET", "source": list(scheduled_sources)}, source, NO_STORE),
        ({"thingType": "SOH"}, bridge, stock),
        ({"thingType": "SOHSTREAM"}, bridge, stock),
        ({"thingType": "DISCREPANCY", "specName": "", "bridgeKey_2": "ANALYTICS", "source": "N/A", "sourceModule": "N/A", "Retail_Bizstep": "N/A"}, bridge, strip_zeros(store_number)),
        ({"thingType": "LOCATION", "specName": "", "bridgeKey_2": "EPCIS", "source": "N/A", "sourceModule": "N/A", "Retail_Bizstep": "N/A"}, bridge, NO_STORE),
        ({"thingType": "PRODUCT", "specName": "", "bridgeKey_2": "FTPBRIDGEPRODUCTS", "source": "N/A", "sourceModule": "N/A", "Retail_Bizstep": "N/A"}, bridge, NO_STORE),
        ({"thingType": "STORE", "specName": "", "bridgeKey_2": pattern("ALEB%")}, reader, reader_store),
        ({"thingType": "CONTENT"}, bridge, content),
        ({"thingType": "STOREATTRIBUTES", "bridgeKey_2": pattern("FTPBRIDGE%")}, "FTPBRIDGE", store_number),
        ({"thingType": "PRODUCT", "specName": list(product_specs), "bridgeKey_2": "SERVICES", "source": "N/A", "sourceModule": "N/A", "Retail_Bizstep": "N/A"}, bridge, NO_STORE),
    ]
