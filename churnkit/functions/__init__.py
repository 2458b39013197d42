from churnkit.functions.scalar import *  # noqa: F401,F403
from churnkit.functions.durations import IsoDuration, parse_duration, shift_date  # noqa: F401
