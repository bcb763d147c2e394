"""Column expressions: each takes columns and returns a column, with no action."""

from tamiz.functions.dates import *  # noqa: F401,F403
from tamiz.functions.numeric import *  # noqa: F401,F403
from tamiz.functions.text import *  # noqa: F401,F403
