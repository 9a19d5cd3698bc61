"""The one exception a job guard raises."""


class JobFailed(RuntimeError):
    """A guard found the job's input or output unacceptable; nothing was published."""
