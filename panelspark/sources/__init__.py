"""Landing, normalisation and storage of vendor records: typed columns, keys, upserts, versions, calendars."""
