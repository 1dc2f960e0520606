"""Ready-made task specs. Prompts and input templates are our own wording."""

from __future__ import annotations

from stillhouse.sources.specs import FREE_TEXT, JSON, SINGLE_LABEL, TaskSpec


def _grid(openings: list[str], endings: list[str]) -> list[str]:
    return [f"{a} {b}" for a in openings for b in endings]


TICKET_ROUTING = TaskSpec(
    name="ticket_routing",
    display_name="Support Ticket Routing",
    teacher_prompt=(
        "Route the support ticket below to one team.\n"
        "billing handles money: charges, invoices, refunds, plans. technical handles things that are broken.\n"
        "account handles access: sign-in, passwords, permissions, profiles. general handles the rest.\n"
        "Decide by what the customer wants solved. Answer with one word.\n\nTicket:\n{input}"
    ),
    # Labels, answer pattern and token estimates.
    labels=["billing", "technical", "account", "general"],
    output_format=SINGLE_LABEL,
    output_regex=r"\b(billing|technical|account|general)\b",
    teacher_input_tokens=350,
    student_input_tokens=40,
    teacher_output_tokens=2,
    student_output_tokens=1,
    synthetic_input_templates=_grid(
        ["Since Monday", "For case {idx}", "After the upgrade", "On the team plan", "In the new console"],
        [
            "the invoice lists a charge nobody ordered.",
            "every upload ends in a server error.",
            "two colleagues are locked out of the workspace.",
            "we would like a tour of the reporting screens.",
            "the refund promised last week is missing.",
        ],
    ),
)

PII_DETECTION = TaskSpec(
    name="pii_detection",
    display_name="PII Detection",
    teacher_prompt=(
        "List every piece of personal data in the text as a JSON array of objects with the keys entity and type,\n"
        "for example [{{\"entity\": \"kim@example.org\", \"type\": \"email\"}}]. Copy spans exactly, list each once.\n"
        "Types: person, email, phone, ssn, address, credit_card. Without any, answer [].\n\nText:\n{input}"
    ),
    # Labels and token estimates.
    labels=["person", "email", "phone", "ssn", "address", "credit_card"],
    output_format=JSON,
    teacher_input_tokens=500,
    student_input_tokens=60,
    teacher_output_tokens=50,
    student_output_tokens=30,
    synthetic_input_templates=_grid(
        ["Parcel {idx}:", "Form {idx}:", "Please note for file {idx}:", "Call back", "Forward to"],
        [
            "Ines Halvorsen, ines{idx}@example.org.",
            "Tomas Brandt at (555) 010-4477.",
            "Lea Okafor, 12 Mill Road, Ashford, before noon.",
            "Raj Mehta, card 4000-0000-0000-0002.",
            "Nora Lindqvist, number 000-12-3456 on record.",
        ],
    ),
)

SQL_GENERATION = TaskSpec(
    name="sql_generation",
    display_name="SQL Generation",
    teacher_prompt=(
        "Write one PostgreSQL query that answers the question, ending with a semicolon and without fences.\n"
        "Tables: users(id, email, name, country, created_at), products(id, name, category, price, stock, created_at),\n"
        "orders(id, user_id, status, total, created_at), order_items(id, order_id, product_id, quantity, unit_price).\n"
        "Today is 2025-06-15.\n\nQuestion:\n{input}"
    ),
    # Token estimates.
    labels=[],
    output_format=FREE_TEXT,
    student_model="Qwen/Qwen3-VL-235B-A22B-Instruct",
    teacher_input_tokens=800,
    student_input_tokens=80,
    teacher_output_tokens=60,
    student_output_tokens=40,
    teacher_temperature=0.0,
    synthetic_input_templates=_grid(
        ["By country,", "By month,", "For product {idx},", "Among delivered orders,", "Over the last year,"],
        [
            "what was the revenue?",
            "how many orders were there?",
            "which customers bought most?",
            "what did an average order cost?",
            "how many items were sold?",
        ],
    ),
)

SENTIMENT_ASPECT = TaskSpec(
    name="sentiment_aspect",
    display_name="Sentiment + Aspect Extraction",
    teacher_prompt=(
        "Read the review and answer with one JSON object such as\n"
        "{{\"sentiment\": \"positive\", \"aspect\": \"delivery\", \"confidence\": 0.9, \"reasoning\": \"Praises the speed\"}}.\n"
        "sentiment is positive, negative, neutral or mixed; aspect is its main subject in snake case;\n"
        "confidence lies between 0 and 1; reasoning is one short sentence.\n\nReview:\n{input}"
    ),
    # Labels, compared keys and token estimates.
    labels=["positive", "negative", "neutral", "mixed"],
    output_format=JSON,
    json_compare_keys=["sentiment", "aspect"],
    teacher_input_tokens=450,
    student_input_tokens=60,
    teacher_output_tokens=40,
    student_output_tokens=30,
    synthetic_input_templates=_grid(
        ["The lamp", "Our second kettle", "This backpack", "Order {idx}", "The phone case"],
        [
            "arrived early and looks lovely.",
            "broke within a week.",
            "does what the box says.",
            "is well made but costs too much.",
            "came with friendly, quick support.",
        ],
    ),
)

RECEIPT_EXTRACTION = TaskSpec(
    name="receipt_extraction",
    display_name="Receipt Data Extraction",
    teacher_prompt=(
        "Read the receipt text and answer with one JSON object with the keys vendor, date, total and line_items\n"
        "(a list of objects with name and price). Use null for what is not shown.\n\nReceipt:\n{input}"
    ),
    # Token estimates.
    labels=[],
    output_format=JSON,
    teacher_input_tokens=900,
    student_input_tokens=200,
    teacher_output_tokens=150,
    student_output_tokens=100,
    synthetic_input_templates=_grid(
        ["Corner Shop {idx}", "Harbour Cafe", "Nova Books", "Green Grocer", "Till {idx}"],
        ["tea 2.40 total 2.40", "bread 3.10 milk 1.20 total 4.30", "pens 5.00 total 5.00", "soup 6.75", "tickets 18.00"],
    ),
)

LANGUAGE = TaskSpec(
    name="language",
    display_name="Language Classification",
    teacher_prompt=(
        "Name the language of the text: ar, de, el, en, es, fr, hi, ru, tr, ur, vi, zh, or ot if unsure.\n"
        "Ignore links, addresses and numbers. Answer with one line: Final Answer: xx\n\nText:\n{input}"
    ),
    # Labels, answer pattern and measured token counts.
    labels=["ar", "de", "el", "en", "es", "fr", "hi", "ru", "tr", "ur", "vi", "zh", "ot"],
    output_format=SINGLE_LABEL,
    output_regex=r"Final Answer:\s*(\w+)",
    teacher_input_tokens=641,
    student_input_tokens=24,
    teacher_output_tokens=4,
    student_output_tokens=1,
    synthetic_input_templates=_grid(
        ["Sie sagte,", "She said", "Elle a dit", "Ella dijo", "Letter {idx}:"],
        [
            "the train was late again.",
            "der Zug war wieder zu spät.",
            "le train était encore en retard.",
            "el tren llegó tarde otra vez.",
            "no. 12 / 34",
        ],
    ),
)

TEXT_TASKS = [TICKET_ROUTING, PII_DETECTION, SQL_GENERATION, SENTIMENT_ASPECT]
ALL_TASKS = [*TEXT_TASKS, RECEIPT_EXTRACTION, LANGUAGE]
