"""Small synthetic exports, one folder per family and month."""

from __future__ import annotations

import csv
import io
import json
from pathlib import Path

SALT = "a-test-salt-of-some-length"

CONFIG = {
    "sources": {
        "chargebee": ["Chargebee Form", "Chargebee"],
        "freshdesk": ["Freshdesk Tickets", "Freshdesk"],
        "mbg": ["MBG Form", "MBG"],
        "sprig": ["Surveys", "Sprig"],
        "lyssna": ["Lyssna Tests", "Lyssna"],
        "interviews": ["Interviews"],
    },
    "freshdesk": {
        "exclude_internal_domains": ["ours.test"],
        "exclude_automated_patterns": ["no-reply", "noreply", "mailer-daemon", "postmaster"],
        "sender_types": {"payment_dispute": ["paypal.com", "stripe.com"], "marketplace": ["shop.example"]},
    },
}

TAXONOMY = {
    "version": 3,
    "areas": [
        {"id": "billing", "label": "Billing", "keywords": ["charge", "charged", "refund", "free trial", "trial"]},
        {"id": "price", "label": "Price", "keywords": ["expensive", "cost", "not worth"]},
        {"id": "quality", "label": "Quality", "keywords": ["wrong", "inaccurate", "no longer use"]},
        {"id": "assistant", "label": "Assistant", "keywords": ["a.i.", "chatbot"]},
    ],
    "source_map": {
        "chargebee_reason": {"Too expensive for me": {"area": "price", "theme": "too_expensive"}},
        "freshdesk_sender_type": {"payment_dispute": {"area": "billing", "theme": "payment_dispute"}},
    },
}

CANCEL_HEADER = [
    "exit_session_id", "internal_id", "email", "ownerFirstName", "ownerLastName", "ownerFullName", "reason",
    "details", "competitor", "returnLikelihood", "mrr", "Cancel date", "startTime", "Customer Audience", "Plan ID",
    "Billing ID", "Coupon Codes", "reasonOther",
]
CANCEL_1 = [
    ["s1", "101", "Ann.Lee@Mail.com", "Ann", "Lee", "Ann Lee", "Too expensive for me", "Ann said call 555-123-4567",
     "Rival", "7", "1,234.5", "2026-07-03T10:00:00.250Z", "", "Book Club Member", "gold", "B-1", "SAVE10", ""],
    ["s2", "cust_9", "bob@mail.com", "Bob", "Stone", "Bob Stone", "Other", "Line one\nline \"two\" from Ann Lee", "", "",
     "", "bad date", "2026-07-04T11:00:00Z", "student", "", "", "", "I was charged twice"],
    ["", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "", ""],
    ["s1", "101", "ann.lee@mail.com", "Ann", "Lee", "Ann Lee", "Other", "copy", "", "", "", "", "", "", "", "", "", ""],
    ["s3", "102"],
]
CANCEL_2 = [
    ["s2", "cust_9", "bob@mail.com"],
    ["s4", "101", "ann.lee@mail.com", "Ann", "Lee", "Ann Lee", "Other", "wrong info", "", "", "", "2026-08-02T09:00:00.000Z", "", "", "silver"],
]

SURVEY_HEADER = [
    "surveyId", "surveyName", "visitorId", "userId", "responseGroupUid", "createdAt", "href",
    "Q1_Question_Text", "Q1_Response", "Q1_Value", "Q1_Response_NPSCategory",
    "Q2_Question_Text", "Q2_Response", "Q2_Theme", "Q2_Theme_1", "Q2_Theme_2",
    "Q3_Question_Text", "Q3_Response", "Q3_Response_Other", "Q3_Choice_1", "Q3_Choice_2",
    "Attribute_1", "Attribute_2", "Attribute_3", "Attribute_4", "Attribute_5", "Attribute_6",
]
SURVEY_LABELS = [
    "", "", "", "", "", "", "", "How likely are you to recommend us?", "", "", "", "Why  that\nscore?", "", "", "Too expensive", "Design",
    "Which device?", "", "", "Phone", "Tablet", "email", "firstName", "lastName", "isStaff", "appVersion", "planId",
]
SURVEY = [
    ["9", "NPS main", "v1", "103", "r1", "07/05/2026 08:30:00", "https://x.test/?mail=me@mail.com", "", "9", "", "Promoter",
     "", "Great, Carol Poe told me", "", "1", "0", "", "", "other device", "1", "", "carol@mail.com", "Carol", "Poe", "", "3.1", "p1"],
    ["9", "NPS main", "v2", "", "r2", "07/06/2026 08:30:00", "", "", "3", "", "Detractor", "", "[Skipped by user]", "", "", "",
     "", "", "", "", "", "dan@mail.com", "Dan", "Ray", "", "", ""],
    ["9", "NPS main", "v3", "104", "r3", "not a date", "", "", "8", "", "Passive", "", "", "", "", "", "", "", "", "false", "my pad",
     "eve@mail.com", "Eve", "Fox", "", "", ""],
    ["9", "NPS main", "v4", "105", "r4", "07/07/2026 08:30:00", "", "", "10", "", "Promoter", "", "", "", "", "", "", "", "", "", "",
     "staff@mail.com", "Stu", "Aff", "True", "", ""],
    ["9", "NPS main", "v5", "105", "r4", "07/07/2026 08:30:00", "", "", "10", "", "Promoter", "", "", "", "", "", "", "", "", "", "",
     "staff@mail.com", "Stu", "Aff", "", "", ""],
]

PMF_HEADER = ["surveyName", "responseGroupUid", "createdAt", "Q1_Question_Text", "Q1_Response"]
PMF_LABELS = ["", "", "", "How would you feel if you could no longer use it?", ""]

# Counts of the answers 5, 4, 3, 2, 1 per case and the share of 5 that must come out.
PMF_CASES = {
    "A": ([5, 1, 0, 0, 2], 62.5),
    "B": ([14, 2, 4, 1, 2], 60.9),
    "C": ([17, 6, 6, 1, 9], 43.6),
    "D": ([19, 8, 7, 5, 6], 42.2),
    "E": ([9, 2, 2, 2, 11], 34.6),
}

TICKET_HEADER = ["Date", "Ticket ID", "User", "Segmentation", "Feedback"]
TICKETS = [
    ["2026-07-10 09:00:00", "1", "ann.lee@mail.com", "Cancel my plan - Bob Stone", "Hi Maria,\nplease refund me.\n\nAnn\n"],
    ["2026-07-11 09:00:00", "2", "robot@help.ours.test", "x", "internal"],
    ["2026-07-11 09:30:00", "3", "no-reply@shop.test", "x", "automated"],
    ["2026-07-12 09:00:00", "4", "service@mail.paypal.com", "Dispute",
     "The billing agreement for jane roe was canceled. Contact Jane Roe <jane@roe.com> at once."],
    ["2026-07-12 10:00:00", "2", "late@mail.com", "again", "same id as an internal mail"],
    ["someday", "5", "zoe@mail.com", "Question", "Carol Smith and Bob Builder wrote this"],
]

REFUND_HEADER = [
    "", "Notes", "Amount", "Eligible?", "Timestamp", "Email address", "Your Email again", "Why do you want to cancel?",
    "What would have made you stay?", "Favourite colour",
]
REFUNDS = [
    ["done", "sent to ann.lee@mail.com", "39.99", "yes", "7/20/2026 14:05:09", "ann.lee@mail.com", "", "Too expensive",
     "A lower cost", "red"],
    ["done", "", "10", "no", "7/20/2026 14:05:09", "ann.lee@mail.com", "", "Too expensive", "again", "blue"],
    ["open", "", "n/a", "", "7/21/2026 10:00:00", "nobody", "", "Something was wrong", "", ""],
]

PANEL_HEADER = [
    "Response ID", "Date", "Duration (ms)", "Country", "Device Type",
    '(Screener) (Question 1: "Do you read?") Answer',
    '2. (Questions) (Question 1: "What did you think?") Answer',
    '2. (Questions) (Question 1: "What did you think?") Duration (ms)',
]
PANEL = [
    ["p1", "2026-07-15 10:00:00", "1000", "US", "Mobile", "Yes", "I thought the chatbot was nice, Ann Lee said", "5000"],
    ["p2", "2026-07-15 11:00:00", "2000", "", "Desktop", "No", "https://x.test/ some link here", ""],
    ["p1", "2026-07-15 12:00:00", "1", "", "", "Yes", "a copy of the first answer", ""],
]

INTERVIEW_HEADER = [
    "Users", "Email", "Segment", "Booking date", "Interview date", "Plan", "Snapshot (for Zapier)",
    "Interview recording link", "Additional Notes",
]
INTERVIEWS = [
    ["Gina Hall", "gina@mail.com", "student", "2026-07-01", "August 5, 2026 3:04 PM", "gold",
     "Gina likes book clubs. Gina Hall was charged.", "https://rec.test/1", "mail gina@mail.com"],
    ["Hugo Dean", "", "", "", "", "", "", "", "no show"],
]


def write_csv(path: Path, rows: list[list[str]], bom: bool = False, tail: str = "") -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    text = io.StringIO()
    csv.writer(text).writerows(rows)
    path.write_text(("﻿" if bom else "") + text.getvalue() + tail, encoding="utf-8", newline="")


def pmf_rows(case: str) -> list[list[str]]:
    counts, _ = PMF_CASES[case]
    answers = [score for score, n in zip((5, 4, 3, 2, 1), counts) for _ in range(n)]
    return [[f"PMF: {case}", f"{case}{i}", "08/01/2026 10:00:00", "", str(a)] for i, a in enumerate(answers)]


def write_exports(root: Path) -> None:
    july, august = root / "2026-07", root / "2026-08"
    write_csv(july / "Chargebee Form" / "cancel [1].csv", [CANCEL_HEADER, *CANCEL_1], bom=True, tail="\r\n")
    write_csv(august / "chargebee form" / "_cancel.csv", [CANCEL_HEADER, *CANCEL_2])
    write_csv(august / "Chargebee Form" / "empty.csv", [])
    write_csv(august / "Chargebee Form" / "header only.csv", [CANCEL_HEADER])
    write_csv(july / "Surveys" / "NPS" / "nps + non-bcm (1).csv", [SURVEY_HEADER, SURVEY_LABELS, *SURVEY])
    for case in PMF_CASES:
        write_csv(august / "Surveys" / "PMF" / f"pmf__{case}.csv", [PMF_HEADER, PMF_LABELS, *pmf_rows(case)])
    write_csv(july / "Freshdesk Tickets" / "tickets.csv", [TICKET_HEADER, *TICKETS])
    write_csv(july / "MBG Form" / "refunds.csv", [REFUND_HEADER, *REFUNDS])
    write_csv(july / "Lyssna Tests" / "Book brief hero - results (2).csv", [PANEL_HEADER, *PANEL])
    write_csv(july / "Interviews" / "tracker.csv", [INTERVIEW_HEADER, *INTERVIEWS])
    (july / "Interviews" / "deck_one.md").write_text("Insights about the NPS by Bob Stone, mail a@b.com", encoding="utf-8")
    (august / "broken.pdf").write_bytes(b"%PDF-1.4 ...")
    (august / "notes.xlsx").write_bytes(b"zip")
    (august / "loose.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    (august / ".hidden.csv").write_text("a\n1\n", encoding="utf-8")
    (root / "other").mkdir()
    (root / "other" / "x.csv").write_text("a\n1\n", encoding="utf-8")


def write_taxonomy(path: Path) -> str:
    path.write_text(json.dumps(TAXONOMY), encoding="utf-8")
    return str(path)
