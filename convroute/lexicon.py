"""Term lists, patterns and outcome names of the message router.

Everything in this module is a fixed value: results are only right while these lists, patterns and
names stay exactly as they are.  Terms are matched as plain substrings of the lower-cased message
(no word boundaries); emoji are matched on the message as written.
"""

# --- Fixed values: term lists -------------------------------------------------------------------

RISK_TERMS = (
    "lawyer", "legal action", "sue ", "sue.", "attorney", "court",
    "consumer protection", "regulatory", "press", "media", "publicly",
    "chargeback", "dispute the charge", "reported to my bank",
    "محامي", "قضية", "هيئة حماية المستهلك", "شكوى رسمية", "إعلام",
    "سأنشر", "دعوى",
)

SPAM_TERMS = (
    "win a prize", "click here", "free money", "investment opportunity",
    "crypto", "% off today only", "اربح جائزة", "استثمر الآن", "اضغط هنا",
)

REFUND_TERMS = (
    "refund", "money back", "reimburse",
    "استرجاع", "استرداد", "ارجعوا فلوس", "يرجعوا فلوس", "رجعوا فلوس",
    "استرد", "المبلغ يرجع", "اريد فلوسي", "عايز فلوسي", "عايزة فلوسي",
)

CANCEL_TERMS = ("cancel", "الغاء", "إلغاء", "ألغي", "ألغى")

TRACKING_TERMS = (
    "where is my order", "any update", "still waiting", "eta", "tracking",
    "wheres my", "where's my", "checking on", "following up",
    "وين طلبي", "فين الطلب", "متى يوصل", "هل وصل", "متابعة الطلب",
    "أي جديد", "لسه", "استفسار",
)

RESERVATION_TERMS = ("reservation", "table for", "book a table", "حجز", "طاولة", "ترابيزة")

NEGATIVE_TERMS = (
    "wrong order", "damaged", "broken", "rude", "disgusting",
    "not happy", "disappointed", "unacceptable", "terrible", "awful",
    "missing", "spilled", "worst",
    "سيء", "سيئ", "زعلان", "متضايق", "خربان", "ناقص",
    "قلة احترام", "غير طازة", "مو راضي", "مش راضي", "وسخ",
    "مقرف", "أسوأ",
    "order is late", "delivery is late", "order was late",
    "طلب متأخر", "الطلب متأخر", "الأوردر متأخر", "التوصيل متأخر",
    "وصل متأخر", "اتأخر الطلب",
    "arrived cold", "came cold", "was cold", "tasted cold",
    "وصل بارد", "وصلت بارد", "وصلتني بارد", "جاء بارد", "اكل بارد",
    "الاكل بارد", "الطعام بارد",
)

POSITIVE_TERMS = (
    "thank you", "thanks", "thx", "amazing", "great", "love it", "excellent",
    "perfect", "delicious", "best", "awesome",
    "شكرا", "شكراً", "تسلم", "تسلمون", "يعطيكم العافية", "الحمد لله",
    "ممتاز", "رائع", "حلو", "لذيذ", "احسن", "أحسن",
)

DECLINING_TERMS = ("لا شكر", "no thanks", "لأ شكر")

PHOTO_TERMS = ("صورة", "photo", "screenshot", "image")

# URL starts, in any case; "ſ" is the one letter besides "S" that folds to "s".
URL_TERMS = ("http://", "https://", "httpſ://", "www.")
QUESTION_MARKS = ("?", "؟")
# One of these is part of every order number.
ORDER_NUMBER_TERMS = ("#", "order", "رقم")

NEGATIVE_EMOJI = ("😡", "😠", "😤", "😭", "👎", "🤮", "😞", "😢")
POSITIVE_EMOJI = ("😍", "❤️", "🎉", "😊", "👍", "🥰", "💕")

NEGATION_MARKERS = (
    "مش", "مو ", "مب ", "مافي", "ماكو", "مافيش", "لا ", "ابدا", "أبدا",
    "not ", "isn't", "wasn't", "didn't", "doesn't", "don't", "no ",
)
NEGATION_WINDOW = 20

# Terms of the offline stand-in for the batch classifier.
# The stand-in takes the first label one of whose terms occurs, else the default.
STANDIN_REFUND_TERMS = ("refund", "استرجاع", "استرداد")
STANDIN_COMPLAINT_TERMS = ("سيء", "بارد", "rude", "disappointed")
STANDIN_RULES = (("refund_request", STANDIN_REFUND_TERMS), ("complaint", STANDIN_COMPLAINT_TERMS))
STANDIN_DEFAULT = "order_inquiry"

# --- Fixed values: patterns (Java regex) --------------------------------------------------------
# Digits, word characters and white space are spelt as explicit Unicode classes: Java's own \d, \w
# and \s are ASCII.  A pattern only has to say *whether* a message matches, so repeated ends are cut
# to the shortest form with the same answer; that keeps matching linear in the text length.

SPACE_CLASS = r"\s\p{Z}\x85\x1c-\x1f"
WORD_CLASS = r"\p{L}\p{N}_"

ORDER_NUMBER = (
    rf"(?iu)#[{SPACE_CLASS}]?\p{{Nd}}{{3}}"
    rf"|(?<![{WORD_CLASS}])\p{{Nd}}{{3,}}[{SPACE_CLASS}]?(?:رقم|order)(?![{WORD_CLASS}])"
)
PHONE = rf"\p{{Nd}}[\p{{Nd}}\-{SPACE_CLASS}]{{7,}}\p{{Nd}}"
EMAIL = rf"[{WORD_CLASS}.+-]@[{WORD_CLASS}-]+\.[{WORD_CLASS}.-]"
NON_BLANK = rf"[^{SPACE_CLASS}]"

# --- Fixed values: signal names, in output order ------------------------------------------------

SIGNALS = (
    "is_risk", "is_spam_pattern", "has_bare_url", "has_refund", "has_negative_keyword",
    "has_positive_keyword", "is_declining", "has_tracking", "has_reservation", "has_cancel",
    "has_question", "has_booking_detail",
)
