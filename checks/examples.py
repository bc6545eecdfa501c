"""Messages with the spans that must be found in them, written by hand.

Nothing here comes from the rules, so that they are checked and not repeated.
"""

from __future__ import annotations

# text -> (placeholder, value) in order
EXAMPLES = {
    "Refund $1,500.00 please": [("[REFUND_AMOUNT]", "$1,500.00")],
    "delivered on 2023-06-15": [("[DATE]", "2023-06-15")],
    "period 2023-2024 2025": [("[DATE]", "2023"), ("[DATE]", "2024"), ("[DATE]", "2025")],
    "account 123456789012": [("[BANK_NUMBER]", "123456789012")],
    "card 1234 5678 9012 3456": [],
    "ring (555) 201-1234": [("[PHONE_NUMBER]", "(555) 201-1234")],
    "ring 555.201.1234 or +44 20 7946 0958": [("[PHONE_NUMBER]", "555.201.1234"), ("[PHONE_NUMBER]", "+44 20 7946 0958")],
    "May I return it, march in line": [],
    "it came in May, or May 5": [("[DATE]", "in May"), ("[DATE]", "May 5")],
    "from 10.20.30.40 today": [("[IP_ADDRESS]", "10.20.30.40"), ("[DATE]", "today")],
    "ssn 078-05-1120": [("[US_SSN]", "078-05-1120")],
    "see shop.example.com/help now": [("[URL]", "shop.example.com/help")],
    "pay 1BoatSLRHtKNngkdXEeobR76b53LETtpyT": [("[CRYPTO]", "1BoatSLRHtKNngkdXEeobR76b53LETtpyT")],
    "50 dollars, USD 20 or $ 20": [("[REFUND_AMOUNT]", "50 dollars"), ("[REFUND_AMOUNT]", "USD 20"), ("[REFUND_AMOUNT]", "$ 20")],
    "yesterday, 3 days ago, next week, a month ago": [("[DATE]", "yesterday"), ("[DATE]", "3 days ago"), ("[DATE]", "next week"), ("[DATE]", "a month ago")],
}


def values_sql() -> str:
    """(i, start, ph, value): a row for each span of message number i, 0-based start."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows, number = [], 0
    for text, spans in EXAMPLES.items():
        at = 0
        for ph, value in spans:
            start = text.index(value, at)
            at = start + len(value)
            rows.append(f"({number}, {start}, {quoted(ph)}, {quoted(value)})")
        number += 1
    return f"(values {', '.join(rows)}) as e(i, start, ph, value)"
