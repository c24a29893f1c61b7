"""Column expressions shared by all plans; everything stays inside Catalyst."""

from pitwall.functions.flags import *  # noqa: F401,F403
from pitwall.functions.gaps import *  # noqa: F401,F403
from pitwall.functions.keys import *  # noqa: F401,F403
from pitwall.functions.text import *  # noqa: F401,F403
from pitwall.functions.times import *  # noqa: F401,F403
