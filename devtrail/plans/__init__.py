"""One plan per surveyed job, each a composition of devtrail operators."""
