"""Land-parcel and CRM analytics as Spark DataFrame jobs."""
