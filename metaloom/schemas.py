"""Record types of the engine, and the fixed values that define its semantics."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import types as T

# --------------------------------------------------------------------------- fixed values
# Entity type -> link field of a search document. The guid list is the field name + "guid".
LINK_FIELDS = {
    "m4i_data_domain": "deriveddatadomain",
    "m4i_data_entity": "deriveddataentity",
    "m4i_data_attribute": "deriveddataattribute",
    "m4i_field": "derivedfield",
    "m4i_dataset": "deriveddataset",
    "m4i_collection": "derivedcollection",
    "m4i_system": "derivedsystem",
    "m4i_person": "derivedperson",
    "m4i_generic_process": "derivedprocess",
}

# Related types that never become links when an entity is created.
CREATE_BLACKLIST = ["m4i_data_quality", "m4i_gov_data_quality", "m4i_source"]

# Attributes copied from an entity to its search document.
DOCUMENT_ATTRIBUTES = ["name", "definition", "email"]

IGNORED_TYPES = ["m4i_source"]
PERSON_TYPE = "m4i_person"
UNMAPPED = "unmappedAttributes"

CREATE, UPDATE, DELETE = "ENTITY_CREATE", "ENTITY_UPDATE", "ENTITY_DELETE"
OPERATIONS = [CREATE, UPDATE, DELETE]

CREATED = "EntityCreated"
ATTRIBUTE_AUDIT = "EntityAttributeAudit"
RELATIONSHIP_AUDIT = "EntityRelationshipAudit"
DELETED = "EntityDeleted"
EVENT_TYPES = [ATTRIBUTE_AUDIT, CREATED, DELETED, RELATIONSHIP_AUDIT]

RETENTION_DAYS = 735

# Which attribute of which type points at the parents or at the children of an entity.
# Data, not code: pass another list where the catalog's type system differs.
HIERARCHY_RULES = [
    ("m4i_data_domain", "dataEntity", "child"),
    ("m4i_data_entity", "dataDomain", "parent"),
    ("m4i_data_entity", "attributes", "child"),
    ("m4i_data_attribute", "dataEntity", "parent"),
    ("m4i_system", "collections", "child"),
    ("m4i_collection", "systems", "parent"),
    ("m4i_collection", "datasets", "child"),
    ("m4i_dataset", "collections", "parent"),
    ("m4i_dataset", "fields", "child"),
    ("m4i_field", "datasets", "parent"),
]

# --------------------------------------------------------------------------- record types
REF = "struct<guid:string,typeName:string,relationshipGuid:string,uniqueAttributes:map<string,string>>"
RELATIONSHIPS = f"map<string,array<{REF}>>"


def _entity(attributes: str) -> str:
    return (
        f"struct<guid:string,typeName:string,attributes:{attributes},relationshipAttributes:{RELATIONSHIPS},"
        "classifications:array<string>,labels:array<string>,meanings:array<string>,"
        "createTime:bigint,updateTime:bigint,createdBy:string,updatedBy:string,status:string,version:bigint,"
        "isIncomplete:boolean,homeId:string,proxy:boolean,provenanceType:int,customAttributes:map<string,string>>"
    )


# Attribute values are canonical JSON text (keys sorted, no white space), so that equal values have
# equal text, "1" differs from 1, and a null value ('null') differs from a missing key.
ENTITY = _entity("map<string,string>")

# Shape of a notification as it arrives; attribute values of any kind.
NOTIFICATION = (
    "struct<version:struct<version:string,versionParts:array<int>>,msgCompressionKind:string,msgSplitIdx:int,"
    "msgSplitCount:int,msgSourceIp:string,msgCreatedBy:string,msgCreationTime:bigint,spooled:boolean,"
    "message:struct<eventTime:bigint,operationType:string,type:string,"
    f"entity:{_entity('map<string,variant>')},relationship:map<string,string>>,"
    "_corrupt:string>"
)

ERROR = "struct<stage:string,kind:string,message:string>"
ENTITY_VERSION = f"body {ENTITY}, doc_id string, event_time bigint, msg_creation_time bigint"
ORDER = "struct<ms:bigint,pos:string,guid:string,seq:int,digest:string>"
PATH = "array<struct<guid:string,name:string,type:string>>"

SCORES = [
    "dqscore_accuracy", "dqscore_timeliness", "dqscoresum_accuracy", "dqscore_validity", "dqscore_completeness",
    "dqscoresum_validity", "dqscorecnt_overall", "dqscorecnt_timeliness", "dqscoresum_timeliness",
    "dqscoresum_completeness", "dqscore_uniqueness", "dqscorecnt_completeness", "dqscoresum_uniqueness",
    "dqscore_overall", "dqscorecnt_uniqueness", "businessruleid", "dqscoresum_overall", "dqscorecnt_accuracy",
    "dqscorecnt_validity",
]
DETAILS = [
    "parentguid", "entityname", "definition", "email", "deriveddataownerguid", "deriveddomainleadguid",
    "deriveddatastewardguid",
]
LISTS = [
    "derivedfield", "deriveddataattribute", "deriveddataentity", "qualityguid_completeness", "deriveddataentityguid",
    "derivedsystem", "qualityguid_timeliness", "deriveddataset", "derivedsystemguid", "breadcrumbname",
    "breadcrumbguid", "deriveddataattributeguid", "deriveddatasetnames", "derivedperson", "derivedfieldguid",
    "derivedentityguids", "deriveddatasetguids", "deriveddatasetguid", "derivedprocess", "derivedprocessguid",
    "classificationstext", "qualityguid_uniqueness", "derivedpersonguid", "qualityguid_accuracy",
    "derivedcollection", "deriveddatadomainguid", "derivedcollectionguid", "qualityguid_validity",
    "deriveddatadomain", "derivedentitynames", "breadcrumbtype", "supertypenames",
]

DOCUMENT = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in ("guid", "name", "referenceablequalifiedname", "typename")]
    + [T.StructField("id", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in SCORES]
    + [T.StructField(c, T.StringType()) for c in DETAILS]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in LISTS]
)
DOCUMENT_COLUMNS = DOCUMENT.fieldNames()

# One primitive edit of one search document; see operators.edits.
EDIT = (
    f"doc string, change_id string, ord {ORDER}, kind string, field string, guid string, pos int, "
    f"value string, path {PATH}"
)
CHANGE_COLUMNS = [
    "change_id", "ord", "type_name", "guid", "original_event_type", "event_type", "inserted_attributes",
    "changed_attributes", "deleted_attributes", "inserted_relationships", "changed_relationships",
    "deleted_relationships", "direct_change", "msg_creation_time", "old_value", "new_value",
]


# Stage and kind of all errors.
ERROR_KINDS = [
    ("parse", "validation"), ("validate", "missing_entity"), ("validate", "ignored_type"), ("validate", "ignored_operation"),
    ("lookup", "unknown_type"), ("lookup", "lookup_failed"), ("lookup", "document_not_found"), ("lookup", "related_documents_missing"),
    ("versions", "missing_entity"), ("previous_version", "missing_entity"), ("previous_version", "no_previous_version"),
    ("diff", "value_error"), ("diff", "not_implemented"), ("dispatch", "not_implemented"), ("created", "entity_missing"),
    ("deleted", "entity_missing"), ("attributes", "attribute_missing"), ("attributes", "document_not_found"),
    ("attributes", "entity_missing"), ("attributes", "name_missing"), ("relationships", "child_not_found"),
    ("relationships", "document_not_found"), ("relationships", "entity_missing"), ("relationships", "not_an_ancestor"),
    ("canonical", "cycle"), ("canonical", "parent_missing"), ("import", "cycle"), ("publish", "unreadable_key"),
    ("publish", "unreadable_value"),
]


@lru_cache
def fields_of(ddl: str) -> list[T.StructField]:
    """Fields of a struct given as text; needs a running session."""
    return T.DataType.fromDDL(ddl).fields
