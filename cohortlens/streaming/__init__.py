"""No streaming operators: the reference has no streams, watermarks, windows
over event time or stateful processing, so nothing is built here."""
