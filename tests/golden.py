"""Golden phrases and counts.

Phrase rows: text, true signals, stage-1 label, confidence and reason, and the stage-2 outcome for
(negative .9 / positive .9 / neutral .9 / negative .5); None where stage 1 has already decided.
"""

PHRASES = (
    ("I will call my lawyer", "risk", None, "low", "risk_trigger_escalated_to_api", "esc esc esc esc"),
    ("this issue keeps happening", "risk", None, "low", "risk_trigger_escalated_to_api", "esc esc esc esc"),
    ("express delivery please", "risk", None, "low", "risk_trigger_escalated_to_api", "esc esc esc esc"),
    ("win a prize now", "spam", "spam", "high", "spam_keyword", None),
    ("see https://pay.example.com/r", "url", None, "low", "url_no_context_escalated", "esc esc esc esc"),
    ("photo here https://img.example.com/1", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("#4521 www.example.com", "tracking", "order_inquiry", "high", "tracking_or_reservation_keyword", None),
    ("refund me please", "refund", "refund_request", "high", "refund_keyword", None),
    ("thanks for the refund", "refund pos", None, "low", "conflicting_refund_and_positive", "refund refund refund refund"),
    ("great taste but rude driver", "neg pos", None, "low", "conflicting_negative_and_positive", "complaint compliment - -"),
    ("where is my order", "tracking", "order_inquiry", "high", "tracking_or_reservation_keyword", None),
    ("I need the details", "tracking", "order_inquiry", "high", "tracking_or_reservation_keyword", None),
    ("order was wrong order, any update", "neg tracking", "complaint", "high", "negative_keyword_or_emoji", None),
    ("book a table for 4", "reservation", "order_inquiry", "high", "tracking_or_reservation_keyword", None),
    ("please cancel it", "cancel", "order_inquiry", "high", "tracking_or_reservation_keyword", None),
    ("the food is disgusting", "neg", "complaint", "high", "negative_keyword_or_emoji", None),
    ("arrived cold", "neg", "complaint", "high", "negative_keyword_or_emoji", None),
    ("cold mezze", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("amazing food", "pos", "compliment", "high", "positive_keyword_or_emoji", None),
    ("not amazing", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("not great, but great value", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("amazing food?", "pos question", "order_inquiry", "high", "question_no_negative_signal", None),
    ("what time do you open?", "question", "order_inquiry", "high", "question_no_negative_signal", None),
    ("Ahmed Mansour, +971 50 888 1234", "booking", "order_inquiry", "low", "booking_detail_pattern", None),
    ("sara@example.com", "booking", "order_inquiry", "low", "booking_detail_pattern", None),
    ("ok noted", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("no thanks", "declining", None, "low", "no_confident_signal", "complaint - - -"),
    ("😡", "neg", "complaint", "high", "negative_keyword_or_emoji", None),
    ("❤️", "pos", "compliment", "high", "positive_keyword_or_emoji", None),
    ("❤", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("👍 #123", "pos tracking", "order_inquiry", "high", "tracking_or_reservation_keyword", None),
    ("#12", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("5521 order", "tracking", "order_inquiry", "high", "tracking_or_reservation_keyword", None),
    ("missing item, 5521 order", "neg tracking", "complaint", "high", "negative_keyword_or_emoji", None),
    ("مش حلو", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("الأكل حلو", "pos", "compliment", "high", "positive_keyword_or_emoji", None),
    ("وين طلبي", "tracking", "order_inquiry", "high", "tracking_or_reservation_keyword", None),
    ("وصل بارد", "neg", "complaint", "high", "negative_keyword_or_emoji", None),
    ("عايز فلوسي", "refund", "refund_request", "high", "refund_keyword", None),
    ("شكوى رسمية", "risk", None, "low", "risk_trigger_escalated_to_api", "esc esc esc esc"),
    ("لا شكرا", "declining", None, "low", "no_confident_signal", "complaint - - -"),
    ("متى تفتحون؟", "question", "order_inquiry", "high", "question_no_negative_signal", None),
    ("تمام", "", None, "low", "no_confident_signal", "complaint compliment - -"),
    ("great, chargeback filed", "risk pos", None, "low", "risk_trigger_escalated_to_api", "esc esc esc esc"),
    ("اربح جائزة", "spam", "spam", "high", "spam_keyword", None),
    ("   ", "", None, "low", "empty_message", "complaint compliment - -"),
    ("", "", None, "low", "empty_message", "complaint compliment - -"),
    ("great food but rude, any update?", "neg pos tracking question", None, "low", "conflicting_negative_and_positive", "complaint inquiry inquiry -"),
    ("great food but was it missing?", "neg pos question", None, "low", "conflicting_negative_and_positive", "complaint inquiry(q) inquiry(q) -"),
)

SIGNAL_NAMES = {
    "risk": "is_risk",
    "spam": "is_spam_pattern",
    "url": "has_bare_url",
    "refund": "has_refund",
    "neg": "has_negative_keyword",
    "pos": "has_positive_keyword",
    "declining": "is_declining",
    "tracking": "has_tracking",
    "reservation": "has_reservation",
    "cancel": "has_cancel",
    "question": "has_question",
    "booking": "has_booking_detail",
}

STAGE_2 = {
    "esc": (None, "stage1_signal_escalated"),
    "-": (None, "sentiment_inconclusive"),
    "refund": ("refund_request", "refund_keyword_stage2"),
    "inquiry": ("order_inquiry", "tracking_keyword_stage2"),
    "inquiry(q)": ("order_inquiry", "question_stage2"),
    "complaint": ("complaint", "sentiment_negative_0.90"),
    "compliment": ("compliment", "sentiment_positive_0.90"),
}

# Counts at scale factors 0.001, 0.01 and 0.1.
AUTHORS = {"customer": (48, 279, 2587), "brand": (34, 233, 2121)}
STAGE_1_REASONS = {
    "risk_trigger_escalated_to_api": (7, 30, 296),
    "spam_keyword": (4, 12, 109),
    "url_no_context_escalated": (2, 6, 38),
    "conflicting_refund_and_positive": (0, 7, 56),
    "conflicting_negative_and_positive": (2, 6, 53),
    "refund_keyword": (1, 16, 126),
    "tracking_or_reservation_keyword": (8, 42, 448),
    "negative_keyword_or_emoji": (2, 30, 355),
    "positive_keyword_or_emoji": (5, 11, 120),
    "question_no_negative_signal": (2, 18, 169),
    "booking_detail_pattern": (3, 5, 51),
    "empty_message": (0, 6, 51),
    "no_confident_signal": (12, 90, 715),
}
STAGE_2_OUTCOMES = {
    "stage1_signal_escalated": (9, 36, 334),
    "sentiment_inconclusive": (13, 85, 666),
    "refund_request": (0, 7, 56),
    "order_inquiry": (0, 0, 1),
    "complaint": (1, 7, 80),
    "compliment": (0, 10, 72),
}
STANDIN = {"order_inquiry": (20, 115, 958), "complaint": (2, 6, 42)}
LOW_CONFIDENCE = (25, 126, 1051)
THREADS = (20, 100, 1000)
PRIMARY_DOCUMENTED = {
    "spam": (4, 12, 109),
    "refund_request": (1, 19, 156),
    "order_inquiry": (13, 62, 665),
    "complaint": (1, 5, 54),
    "compliment": (1, 2, 16),
}
PRIMARY_LABEL_ORDER = {
    "refund_request": (1, 22, 177),
    "complaint": (5, 25, 291),
    "order_inquiry": (12, 50, 502),
    "compliment": (1, 3, 18),
    "spam": (1, 0, 12),
}
ORDERS_DIFFER = (6, 32, 329)
