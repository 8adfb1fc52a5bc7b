"""Raw CSV tables to a stored property graph and typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkwright.operators.graph import build_graph, replace_graph
from linkwright.operators.normalize import current_state, entity_core, link_rows, status_log, value_rows, watcher_rows
from linkwright.operators.validate import orphans, placeholder_parents
from linkwright.session import written
from linkwright.sources.csv_tables import ROW_NO, quarantine, read_raw, read_table, typed_table, with_file_order
from linkwright.sources.schemas import ISSUES, RENAMES

TABLES = ["CR_Main", "JIRA_Issues_Detailed", "Confluence_Pages_Detailed", "JIRA_Activities", "CR_CTasks"]
LINK_COLUMNS = {"JIRA_Linked_Issue_ID_Target", "JIRA_Link_Type", "JIRA_Watcher_User"}


def read_tables(spark: SparkSession, folder: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """The five raw tables below ``folder``, without malformed rows, in file order.

    Each is read once, as text, and stored for all that is made from it.
    """
    return {t: written(read_table(spark, f"{folder}/{t}", t, multi_line), t) for t in TABLES}


def malformed_rows(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return quarantine(with_file_order(read_raw(spark, f"{folder}/{table}", table)))[1]


def load_graph(
    spark: SparkSession, folder: str, out: str, null_text: str | None = None, parallel: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Read the tables, build the graph, replace the stored one, and read it back."""
    tables = read_tables(spark, folder)
    vertices, edges = build_graph(
        tables["CR_Main"], tables["JIRA_Issues_Detailed"], tables["Confluence_Pages_Detailed"],
        null_text=null_text, parallel=parallel)
    replace_graph(vertices, edges, out)
    return spark.read.parquet(f"{out}/vertices"), spark.read.parquet(f"{out}/edges")


def normal_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The typed relational tables, parents first; missing issues get placeholder rows."""
    raw = tables["JIRA_Issues_Detailed"]
    issues = typed_table(raw)
    core = [RENAMES.get(c, c) for c in ISSUES if c not in LINK_COLUMNS]
    changes = typed_table(tables["CR_Main"])
    links = link_rows(issues, "JIRA_ID", "JIRA_Linked_Issue_ID_Target", "JIRA_Link_Type")
    activities = typed_table(tables["JIRA_Activities"]).drop(ROW_NO)
    parents = entity_core(issues, "JIRA_ID", core, [ROW_NO])
    for child, key in ((links, "JIRA_Linked_Issue_ID_Target"), (activities, "JIRA_ID")):
        parents = placeholder_parents(child, key, parents, "JIRA_ID", "JIRA_Title")
    state_columns = [c for c in changes.columns if c not in ("CR_ID", ROW_NO)]
    return {
        "JiraIssues": parents,
        "ChangeRequestMaster": current_state(changes, "CR_ID", "CR_Record_Created_At", [ROW_NO]).drop(ROW_NO),
        "ChangeRequests": status_log(changes, "CR_ID", state_columns),
        "ConfluencePages": typed_table(tables["Confluence_Pages_Detailed"]).drop(ROW_NO),
        "JiraIssueLinks": links,
        "JiraIssueWatchers": watcher_rows(issues, "JIRA_ID", "JIRA_Watcher_User"),
        "JiraIssueComponents": value_rows(entity_core(raw, "JIRA_ID", ["JIRA_Components"], [ROW_NO]), "JIRA_ID", "JIRA_Components"),
        "JiraIssueLabels": value_rows(entity_core(raw, "JIRA_ID", ["JIRA_Labels"], [ROW_NO]), "JIRA_ID", "JIRA_Labels"),
        "JiraActivities": activities,
        "CR_CTasks": typed_table(tables["CR_CTasks"]).drop(ROW_NO),
    }


REFERENCES = [
    ("JiraIssueLinks", "JIRA_ID", "JiraIssues", "JIRA_ID"),
    ("JiraIssueLinks", "JIRA_Linked_Issue_ID_Target", "JiraIssues", "JIRA_ID"),
    ("JiraIssueWatchers", "JIRA_ID", "JiraIssues", "JIRA_ID"),
    ("JiraActivities", "JIRA_ID", "JiraIssues", "JIRA_ID"),
    ("CR_CTasks", "CR_ID", "ChangeRequestMaster", "CR_ID"),
]


def write_tables(spark: SparkSession, normal: dict[str, DataFrame], out: str) -> None:
    """Write parents before children; a child with a missing parent stops the load before it is written."""
    for name, rows in normal.items():
        checked = written(rows, name)
        for child, key, parent, parent_key in REFERENCES:
            if child == name:
                lost = orphans(checked, key, spark.read.parquet(f"{out}/{parent}"), parent_key)
                example = lost.select(key).limit(1).collect()
                if example:
                    raise ValueError(f"{child}.{key} has no parent in {parent}: {example[0][0]!r}")
        checked.write.mode("overwrite").parquet(f"{out}/{name}")
