"""Resource identifiers: three disjoint grammars, and the job they imply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grammars.
BRACKETED = r"\A(?:node|nodeSource)\[([^\]]+)\]\.([a-zA-Z][a-zA-Z0-9_-]*)\[([^\]]*)\]\z"
SLASH_FS = r"\Asnmp/fs/([^/\s\[\]]+)/([^/\s\[\]]+)/([^/\s\[\]]+)/(.+)\z"
SLASH_DB = r"\Asnmp/([1-9][0-9]{0,9})/([^/]+)/(.+)\z"
# Jobs, and the group that makes one.
JOB_DEFAULT, JOB_JMX, JOB_SNMP, JVM_GROUP = "opennms", "jmx", "snmp", "opennms-jvm"


def parse_resource(rid: Column) -> Column:
    """struct(node_id, resource_type, resource_instance), null if no grammar
    matches. The instance may be empty."""
    g = lambda p, i: F.regexp_extract(rid, p, i)
    made = lambda n, t, i: F.struct(n.alias("node_id"), t.alias("resource_type"), i.alias("resource_instance"))
    return (
        F.when(rid.rlike(BRACKETED), made(g(BRACKETED, 1), g(BRACKETED, 2), g(BRACKETED, 3)))
        .when(rid.rlike(SLASH_FS), made(F.concat_ws(":", g(SLASH_FS, 1), g(SLASH_FS, 2)), g(SLASH_FS, 3), g(SLASH_FS, 4)))
        .when(rid.rlike(SLASH_DB), made(g(SLASH_DB, 1), g(SLASH_DB, 2), g(SLASH_DB, 3)))
    )


def derive_job(rid: Column, parsed: Column) -> Column:
    group = parsed["resource_type"]
    jmx = rid.startswith("snmp/fs/") & ((group == JVM_GROUP) | group.startswith("jmx-"))
    return F.when(parsed.isNull(), JOB_DEFAULT).when(jmx, JOB_JMX).otherwise(JOB_SNMP)
