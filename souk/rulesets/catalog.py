"""Constant relations of the gold layer: platforms, skill dictionary, calendar.

FIXED VALUES: rows below must equal the reference's inline relations.
Skill patterns are PostgreSQL regexes (``\\m``/``\\M`` word start/end), matched
case-insensitively against ``description || ' ' || job_title``.
"""

# (source_id, source_key, source_name, source_url, source_scope)
PLATFORMS = [
    (1, "rekrute", "ReKrute.com", "https://www.rekrute.com", "Maroc"),
    (2, "dreamjob", "Dreamjob.ma", "https://www.dreamjob.ma", "Maroc"),
    (3, "indeed", "Indeed Maroc", "https://ma.indeed.com", "International"),
    (4, "linkedin", "LinkedIn Jobs", "https://www.linkedin.com", "International"),
]

# (skill_name, skill_pattern, skill_category)
SKILLS = [
    ("Python", r"\mPython\M", "Langage"),
    ("SQL", r"\mSQL\M", "Langage"),
    ("Java", r"\mJava\M", "Langage"),
    ("Scala", r"\mScala\M", "Langage"),
    ("R", r"\mR\M", "Langage"),
    ("Spark", r"\m(Apache\s+)?Spark\M", "Big Data"),
    ("Hadoop", r"\mHadoop\M", "Big Data"),
    ("Kafka", r"\mKafka\M", "Big Data"),
    ("Hive", r"\mHive\M", "Big Data"),
    ("Airflow", r"\mAirflow\M", "Orchestration"),
    ("dbt", r"\mdbt\M", "Transformation"),
    ("Talend", r"\mTalend\M", "ETL"),
    ("Informatica", r"\mInformatica\M", "ETL"),
    ("SSIS", r"\mSSIS\M", "ETL"),
    ("ETL", r"\mETL\M|\mELT\M", "ETL"),
    ("AWS", r"\mAWS\M|\mAmazon\s+Web\s+Services\M", "Cloud"),
    ("Azure", r"\mAzure\M", "Cloud"),
    ("GCP", r"\mGCP\M|\mGoogle\s+Cloud\M", "Cloud"),
    ("Snowflake", r"\mSnowflake\M", "Data Warehouse"),
    ("Databricks", r"\mDatabricks\M", "Data Warehouse"),
    ("Redshift", r"\mRedshift\M", "Data Warehouse"),
    ("BigQuery", r"\mBigQuery\M", "Data Warehouse"),
    ("PostgreSQL", r"\mPostgreSQL\M|\mPostgres\M", "Base de données"),
    ("MySQL", r"\mMySQL\M", "Base de données"),
    ("MongoDB", r"\mMongoDB\M", "Base de données"),
    ("Oracle", r"\mOracle\M", "Base de données"),
    ("Power BI", r"\mPower\s*BI\M", "BI / Visualisation"),
    ("Tableau", r"\mTableau\M", "BI / Visualisation"),
    ("Looker", r"\mLooker\M", "BI / Visualisation"),
    ("Excel", r"\mExcel\M", "BI / Visualisation"),
    ("Machine Learning", r"\mMachine\s+Learning\M|\bML\M", "Machine Learning"),
    ("Deep Learning", r"\mDeep\s+Learning\M", "Machine Learning"),
    ("NLP", r"\mNLP\M|\bNatural\s+Language\b", "Machine Learning"),
    ("TensorFlow", r"\mTensorFlow\M", "Machine Learning"),
    ("PyTorch", r"\mPyTorch\M", "Machine Learning"),
    ("Scikit-learn", r"\mScikit[- ]learn\M|\msklearn\M", "Machine Learning"),
    ("Pandas", r"\mPandas\M", "Machine Learning"),
    ("NumPy", r"\mNumPy\M", "Machine Learning"),
    ("Docker", r"\mDocker\M", "DevOps"),
    ("Kubernetes", r"\mKubernetes\M|\mK8s\M", "DevOps"),
    ("Git", r"\mGit\M|\mGitHub\M|\mGitLab\M", "DevOps"),
    ("Linux", r"\mLinux\M|\mUnix\M", "DevOps"),
]

# Calendar range of dim_date (inclusive) and French labels.
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2026-12-31"
MONTH_NAMES = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août",
               "Septembre", "Octobre", "Novembre", "Décembre"]
DAY_NAMES = ["Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi"]  # 0 = Sunday
