from .columns import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
