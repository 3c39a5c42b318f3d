"""Input schemas (FIXTURES.md, section A), as DDL texts every reader takes. Reads never infer a schema."""

from __future__ import annotations

from pyspark.sql import types as T


def all_text(*names: str) -> T.StructType:
    """Reference tables arrive as text files in which every column is text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


EVENT_HEADER = (
    "id string, serialNumber string, tenantCode string, thingType string, specName string, bridgeKey string, time timestamp"
)
EVENT_ATTRIBUTE = ("metadataId string, serialNumber string, key string, value string, time timestamp")
REFERENCE_LIST = (
    "serialNumber string, tenantCode string, key string, value string, rflSiteCode string, time timestamp"
)
PROCESS_LIST = all_text("KeyField_L", "FeatureSet", "Process", "SubProcess")
BILLING_LINE = (
    "service struct<id:string,description:string>, sku struct<id:string,description:string>, "
    "project struct<id:string,number:string>, usage struct<amount:double,unit:string>, "
    "resource struct<name:string,global_name:string>, "
    "credits array<struct<name:string,amount:double,full_name:string,id:string,type:string>>, "
    "cost double, cost_type string, usage_start_time timestamp"
)
PROJECT_DIMENSION = all_text(
    "id", "provider", "tier", "bu", "costType", "category", "subCategory",
    "EntityFinance", "CategoryFinance", "tenantFinance", "ResourceGr", "unitFinance", "Class",
)
COLLECTION_SIZE = (
    "date timestamp, tenant string, real_name string, size_db bigint, size_storage bigint, size_index bigint"
)
DATABASE_SIZE = ("date timestamp, shard_id string, tenant string, size_on_disk bigint")
INGRESS_REQUEST = (
    "time timestamp, method string, uri string, host string, status int, length bigint, latency double, "
    "source string, user string, apikey string, auth string, token string"
)
API_KEY = all_text("apiKey_l", "Description")
DEPLOYED_SITE = (
    "timestamp timestamp, environment string, tenant_parent_code string, id string, hierarchyCode string"
)
TENANT_COST = ("date_LA_2 date, tenant_full string, compute_cost double, storage_cost double")
PREMISE = (
    "tenant string, code string, bizLocation string, name string, level string, type string, "
    "addressCountry string, latitude double, longitude double"
)
ZONE = ("tenant string, code string, bizLocation string, hierarchy struct<premiseId:string>")
FIXTURE = ("tenant string, id string, locationCode string, premise string, bizLocation string")
ITEM_STATUS = (
    "tenant string, premise string, disposition string, bizStep string, action string, "
    "gtin string, sku string, hexa string"
)
PRODUCT = all_text(
    "gtin", "productLabelLong", "categoryParent", "brandLabel", "modelLabel", "colorCode", "imageURL", "contentQty",
    "packagingUOM", "categoryLevel1Label", "categoryLevel2Label", "categoryLevel3Label", "categoryLevel4Label",
)
WEATHER_PAYLOAD = ("code string, hourly struct<time:array<string>,temperature_2m:array<double>>")
SALES = (
    "`Thing Type Code` string, `Thing Serial` string, `Thing Name` string, `Owner Group` string, "
    "`Alias Config` string, date string, categoryParent string, siteCode string, siteName string, "
    "fixture string, totalSalesUSD double, totalSalesQty int"
)
TIME_OFF = ("name string, start date, end date")
WEEK_TO_SPRINT = all_text("YEAR_WEEK", "RESOURCE_SPRINT_NAME")

# Declared schemas of the outputs; ``sinks.conform`` brings a frame into them before it is written.
ALLOCATED_EVENTS = (
    "datetime_h timestamp, tenantCode string, thingType string, specName string, bridgeKey_2 string, source string, "
    "sourceModule string, Retail_Bizstep string, FeatureSet string, Process string, SubProcess string, "
    "EventSource string, StoreCode string, Is_InternalEvent string, event_count bigint, "
    "cost_per_1000 double, cost_per_1000_after_discount double, allocated_cost double, "
    "allocated_cost_after_discount double, datetime_h_local timestamp_ntz"
)
PROJECT_COSTS = (
    "usage_start_time timestamp, id_project string, service_description string, sku_description string, "
    "usage_unit string, total_cost double, total_amount double, total_after_discounts double, "
    "total_amount_credits double, total_compute_cost double, total_storage_cost double, "
    "total_promotion_credits double, provider string, tier string, bu string, costType string, category string, "
    "subCategory string, EntityFinance string, CategoryFinance string, tenantFinance string, ResourceGr string, "
    "unitFinance string, Class string, usage_start_time_local timestamp_ntz"
)
MONTHLY_ALLOCATION = (
    "datetime_h timestamp, tenantCode string, thingType string, event_count_h bigint, cost_assigned double, "
    "cost_assigned_after_discount double, environment string, datetime_h_local timestamp_ntz"
)
SITE_COSTS = (
    "day string, tenant string, compute_cost double, storage_cost double, deployed_sites double, total_sites double, "
    "total_cost double"
)
STORAGE_ALLOCATION = (
    "environment string, day string, tenant string, real_name string, size_storage bigint, "
    "size_storage_percentage double, storage_cost_assigned double, storage_cost_assigned_after_discounts double"
)
