"""Micro-batch caller for the failure notification run."""

from opslog.streaming.polling import start_failure_polling  # noqa: F401
