"""Column names of the raw tables and the typed relational targets.

The names are fixed values: the CSV headers and table columns that users already have.
"""

from __future__ import annotations

from pyspark.sql import types as T

ISSUES = [
    "JIRA_ID", "JIRA_Type", "JIRA_Priority", "JIRA_Components", "JIRA_Labels", "JIRA_Sprint",
    "JIRA_App_Name", "JIRA_Reporter", "JIRA_Assignee", "JIRA_Start_Date", "JIRA_End_Date",
    "JIRA_Status", "JIRA_Title", "JIRA_Description", "JIRA_Release_Fix_Version", "JIRA_Team",
    "JIRA_Confidence", "JIRA_Created_Date", "JIRA_Updated_Date", "JIRA_Effort_Story_Points",
    "CR_ID_Link_From_CSV_Example", "JIRA_Linked_Issue_ID_Target", "JIRA_Link_Type", "JIRA_Watcher_User",
]
CHANGES = [
    "CR_ID", "CR_Title", "Linked_Jira_ID", "Linked_Confluence_ID", "CR_State", "CR_Requested_By",
    "CR_Team_Assignment_Group", "CR_Assigned_To_User", "CR_Impacted_Environment",
    "CR_Impacted_Departments", "CR_Type", "CR_Category", "CR_Risk", "CR_Risk_Percentage",
    "CR_Lead_Time_Days", "CR_Conflict_Status", "CR_Description", "CR_Start_Date", "CR_End_Date",
    "CR_Implementation_Plan_Summary", "CR_Backout_Plan_Summary",
    "CR_Updated_By_User_From_CSV_Example", "CR_Created_At_From_CSV_Example",
]
PAGES = [
    "Confluence_ID", "Confluence_Title", "Confluence_Owner_Member", "Confluence_Last_Edited_By",
    "Confluence_Space", "Confluence_Team_Association", "Confluence_Content_Summary",
    "Confluence_Linked_Jira_ID", "Confluence_Linked_CR_ID", "Confluence_Parent_Page_ID",
    "Confluence_Created_Date", "Confluence_Last_Modified_Date",
]
ACTIVITIES = ["Activity_ID", "JIRA_ID", "Activity_Comment", "Activity_Timestamp", "Activity_User"]
TASKS = ["CTASK_ID", "CR_ID", "CTASK_Assigned_To_User", "CTASK_Start_Time", "CTASK_End_Time", "CTASK_Description"]

RAW = {
    "JIRA_Issues_Detailed": ISSUES,
    "CR_Main": CHANGES,
    "Confluence_Pages_Detailed": PAGES,
    "JIRA_Activities": ACTIVITIES,
    "CR_CTasks": TASKS,
    # first generation of the tables
    "JIRA_Issues": ["jira_id", "jira_summary", "cr_id"],
    "Change_Requests": ["cr_id", "cr_title", "cr_status", "created_at", "updated_by_user", "team_name"],
    "Confluence_Docs": ["confluence_doc_id", "doc_topic", "cr_id"],
    "Confluence_Enriched": ["confluence_doc_id", "doc_topic", "jira_summary", "cr_title", "doc_content"],
}

# Raw column -> target column, where the two differ.
RENAMES = {
    "CR_ID_Link_From_CSV_Example": "CR_ID_Link",
    "CR_Updated_By_User_From_CSV_Example": "CR_Updated_By_User",
    "CR_Created_At_From_CSV_Example": "CR_Record_Created_At",
    "Activity_ID": "Activity_ID_Source",
    "CTASK_ID": "CTASK_ID_Source",
}

# Target column -> type, for every target column that is not text.
TYPES = {
    "JIRA_Start_Date": "date", "JIRA_End_Date": "date", "JIRA_Created_Date": "date",
    "JIRA_Updated_Date": "date", "JIRA_Confidence": "int", "JIRA_Effort_Story_Points": "decimal(5,1)",
    "CR_Risk_Percentage": "int", "CR_Lead_Time_Days": "int", "CR_Start_Date": "date",
    "CR_End_Date": "date", "CR_Record_Created_At": "date",
    "Confluence_Created_Date": "date", "Confluence_Last_Modified_Date": "date",
    "Activity_Timestamp": "timestamp", "CTASK_Start_Time": "timestamp", "CTASK_End_Time": "timestamp",
}

AUDIT_SCHEMA = T.StructType([
    T.StructField("AuditLogID", T.LongType()),
    T.StructField("QuestionaireID", T.LongType()),
    T.StructField("OldQuestion", T.StringType()),
    T.StructField("NewQuestion", T.StringType()),
    T.StructField("OldAnswer", T.StringType()),
    T.StructField("NewAnswer", T.StringType()),
    T.StructField("ActionTaken", T.StringType()),
    T.StructField("ActionTimestamp", T.TimestampType()),
    T.StructField("ActionUser", T.StringType()),
    T.StructField("IsNotified", T.BooleanType()),
])


def text_schema(columns: list[str], extra: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, *extra)])
