"""Column expressions on users, actions and sessions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchtide.functions.moments import session_slot
from searchtide.functions.text import dictionary


def session_action(category: Column) -> Column:
    return F.coalesce(dictionary({"quit": "ABANDON", "enter": "SUBMIT"})[category], F.upper(category))


def is_abandoned(category: Column) -> Column:
    """Null when the category is null."""
    return category == "quit"


def hashed(text: Column) -> Column:
    return F.sha2(text, 256)


def session_text(user: Column, provider: Column, platform: Column, moment: Column) -> Column:
    """Readable session key. Guests share a key per provider, platform and half hour; null if a part is missing."""
    owner = F.when(user.isNotNull(), user).otherwise(F.concat(provider, F.lit("|"), platform))
    return F.concat(owner, F.lit("|"), session_slot(moment))
