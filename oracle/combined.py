"""Oracle steps combining gaps and persistence."""

from oracle import gaps as OG
from oracle import persistence as OP

BASE = OG.BASE + ["method_priority"]
STEPS = OP.STEPS + OG.DRAFT_STEPS
