"""Message layouts and headings whose text must not change, and prompts.

``{name}`` marks a value. ``render`` turns a layout into one concat expression.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_INPUT = "No valid input provided."
RECORD_END = "\n---\n"
GLOBAL_SECTIONS = [
    ("\n=== Global Jira Data ===\n", "JIRA"),
    ("\n=== Global CR Data ===\n", "CR"),
    ("\n=== Global Confluence Data ===\n", "Confluence"),
]

NODE_HEADER = "--- Related to node {node} ---"
NODE_LINE = "{edge} → {kind} [{other}]"
HIT_BLOCK = "\n### Context for {kind} {node}:\n{text}\n\n{context}"

# Prompts: wording of this library, no consumer reads them.
SHORT_PROMPT = "Answer the question from this graph context.\n\n{context}\n\nQuestion: {question}\nAnswer:"
LONG_PROMPT = "Use the records and links below, and nothing else, to answer.\n\n{context}\n\nQuestion: {question}\nAnswer:"
SERVICE_PROMPT = "These records and links belong to the request.\n\n{context}\n\nQuestion: {question}\nAnswer:"
SERVICE_QUESTION = "Give me details about {subject}"
SUMMARY_PROMPT = "Summarise in two or three paragraphs what a wiki page with this title is about: {topic}"
MODEL_ERROR = "AI error: "

TABLE_HEAD = """
    <html><head><style>
        table { font-family: Arial, sans-serif; border-collapse: collapse; width: 100%; }
        td, th { border: 1px solid #dddddd; text-align: left; padding: 8px; }
        tr:nth-child(even) { background-color: #f2f2f2; }
        h2, h3, h4 { color: #333366; }
    </style></head><body>
    <h2>Agent Questionnaire Change Notification</h2>
    <p>An action occurred on the Agent Questionnaire table:</p>
    <table>
        <tr><td><strong>Action:</strong></td><td>{action}</td></tr>
        <tr><td><strong>Questionnaire ID:</strong></td><td>{id}</td></tr>
        <tr><td><strong>Timestamp:</strong></td><td>{time}</td></tr>
        <tr><td><strong>User:</strong></td><td>{user}</td></tr>
    </table>
   \x20"""
TABLE_GROUP = ("<table>", "</table>")
TABLE_ROW = "<tr><td><strong>{label}:</strong></td><td>{value}</td></tr>"
TABLE_OTHER = "<p>Unknown action type or details not fully available.</p>"
TABLE_TAIL = "<hr><p><em>This is an automated notification.</em></p></body></html>"

LIST_HEAD = """
        <html><body>
        <h2>Agent Questionnaire Change Notification</h2>
        <p>An action occurred on the Agent Questionnaire table:</p>
        <ul>
            <li><strong>Action:</strong> {action}</li>
            <li><strong>Questionnaire ID:</strong> {id}</li>
            <li><strong>Timestamp:</strong> {time}</li>
            <li><strong>User:</strong> {user}</li>
        </ul>
       \x20"""
LIST_GROUP = ("", "")
LIST_ROW = "<p><strong>{label}:</strong> {value}</p>"
LIST_TAIL = "<p>--- End of Notification ---</p></body></html>"
LIST_ERROR = "Error formatting email: {error}\nData received: {record}"

# action -> groups of (heading, rows of (label, audit field))
DETAILS = {
    "INSERT": [("<h3>New Entry Details:</h3>", [("Question", "NewQuestion"), ("Answer", "NewAnswer")])],
    "DELETE": [("<h3>Deleted Entry Details:</h3>", [("Question", "OldQuestion"), ("Answer", "OldAnswer")])],
    "UPDATE": [
        ("<h3>Updated Entry Details:</h3><h4>Before Change:</h4>",
         [("Old Question", "OldQuestion"), ("Old Answer", "OldAnswer")]),
        ("<h4>After Change:</h4>", [("New Question", "NewQuestion"), ("New Answer", "NewAnswer")]),
    ],
}
AUDIT_SUBJECT = "Questionnaire Change: {action} on ID {id}"

EDGE_MESSAGE = (
    "Gremlin Edge Updated/Created: \n"
    "  Label: '{label}' (ID: {id})\n"
    "  From: Vertex '{source_label}' (ID: {source_id})\n"
    "  To:   Vertex '{target_label}' (ID: {target_id})"
)
VERTEX_MESSAGE = "Gremlin Vertex Updated/Created: \n  Label: '{label}' (ID: {id})"
EDGE_SUBJECT = "Gremlin Edge Update: {label} ({id})"
VERTEX_SUBJECT = "Gremlin Vertex Update: {label} ({id})"
UNKNOWN = {
    "id": "Unknown ID", "label": "Unknown Label",
    "outVLabel": "UnknownSourceLabel", "inVLabel": "UnknownTargetLabel",
    "source": "UnknownSourceID", "target": "UnknownTargetID",
}

_MARK = re.compile(r"\{(\w+)\}")


def render(layout: str, **values: Column | str) -> Column:
    """A layout with its marks replaced by columns; text between the marks stays literal."""
    pieces: list[Column] = []
    for i, piece in enumerate(_MARK.split(layout)):
        if i % 2:
            value = values[piece]
            pieces.append(F.lit(value) if isinstance(value, str) else value.cast("string"))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def details(row: str, group: tuple[str, str], other: str, action: Column, fields: Mapping[str, Column]) -> Column:
    """The action-dependent middle of a notification."""
    choice = None
    for name, groups in DETAILS.items():
        pieces: list[Column] = []
        for heading, rows in groups:
            pieces.append(F.lit(heading + group[0]))
            pieces += [render(row, label=label, value=fields[field]) for label, field in rows]
            pieces.append(F.lit(group[1]))
        body = F.concat(*pieces)
        choice = F.when(action == name, body) if choice is None else choice.when(action == name, body)
    return choice.otherwise(F.lit(other))
